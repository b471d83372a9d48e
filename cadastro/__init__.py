"""cadastro: consolidate large public-registry dumps into clean, typed, labelled tables on Spark."""

__version__ = "0.1.0"
