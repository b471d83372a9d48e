"""Raw-like registry frames derived from the benchmark tables, written once for two dialects.

The benchmark tables (TPC-H-like, parquet) are reshaped into the raw string layouts of the registry:
numbers become text, dates become ``yyyyMMdd`` text, and bad values (zero dates, blanks, garbage, unknown
codes) are planted deterministically by key arithmetic, so the lenient parsers and checked lookups
have real work. Every row of the source table is kept.

Each derivation is a list of ``(column, SQL expression)`` pairs in a SQL subset that Spark and DuckDB
read alike; the only dialect differences (date formatting) go through :class:`Dialect`. Spark runs them
with ``F.expr``; the DuckDB oracle embeds the same text.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    name: str

    def fmt(self, e: str, spark_pattern: str, duck_pattern: str) -> str:
        if self.name == "spark":
            return f"date_format({e}, '{spark_pattern}')"
        return f"strftime({e}, '{duck_pattern}')"

    def ymd(self, e: str) -> str:
        return self.fmt(e, "yyyyMMdd", "%Y%m%d")

    def ym(self, e: str) -> str:
        return self.fmt(e, "yyyyMM", "%Y%m")

    def listing_stamp(self, e: str) -> str:
        return self.fmt(e, "MM-dd-yy  hh:mma", "%m-%d-%y  %I:%M%p")


    def structs(self, rows: list[tuple[str, str]]) -> str:
        """An array of structs (below, line)."""
        if self.name == "spark":
            return "array(" + ", ".join(f"named_struct('below', {a}, 'line', {b})" for a, b in rows) + ")"
        return "[" + ", ".join(f"{{'below': {a}, 'line': {b}}}" for a, b in rows) + "]"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")
Q = "chr(39)"  # a single quote, spelled the same way in both dialects
NULL_TEXT = "CAST(NULL AS STRING)"


def _s(e: str) -> str:
    return f"CAST({e} AS STRING)"


# ---- lookups -------------------------------------------------------------------------------------------

def lookup_nation(name: str):
    """nation -> raw 2-column lookup (code text, name text)."""
    return [(f"cod_{name}", _s("n_nationkey")), (f"nome_{name}", "n_name")]


def lookup_region(name: str):
    return [(f"cod_{name}", _s("r_regionkey")), (f"nome_{name}", "r_name")]


def lookup_part(name: str):
    return [(f"cod_{name}", _s("p_partkey")), (f"nome_{name}", "p_name")]


def lookup_supplier(name: str):
    return [(f"cod_{name}", _s("s_suppkey")), (f"nome_{name}", "' ' || s_name")]


def lookup_customer(name: str):
    return [(f"cod_{name}", _s("c_custkey")), (f"nome_{name}", "lower(c_name) || ' '")]


# ---- company register -------------------------------------------------------------------------------

def raw_regime(D: Dialect):
    """orders -> simples layout."""
    ymd = D.ymd("o_orderdate")
    return [
        ("cnpj", _s("o_custkey")),
        ("opcao_simples", "o_orderstatus"),
        ("data_inclusao_simples", ymd),
        ("data_exclusao_simples", f"CASE WHEN o_orderkey % 7 = 0 THEN '00000000' ELSE {ymd} END"),
        ("opcao_mei", "CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE 'N' END"),
        ("data_inclusao_mei", f"CASE WHEN o_orderkey % 5 = 0 THEN {NULL_TEXT} ELSE {ymd} END"),
        ("data_exclusao_mei", f"CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE {NULL_TEXT} END"),
    ]


def raw_partners(D: Dialect):
    """orders JOIN customer -> socios layout."""
    return [
        ("cnpj_empresa", _s("o_custkey")),
        ("id_socio", _s("o_orderkey % 5")),
        ("nome_socio", "c_name"),
        ("cpf_cnpj_socio", f"lpad({_s('o_orderkey')}, 11, '0')"),
        ("cod_qual_socio", _s("c_nationkey")),
        ("data_entrada_sociedade", f"CASE WHEN o_orderkey % 13 = 0 THEN '20210230' ELSE {D.ymd('o_orderdate')} END"),
        ("cod_pais", _s("o_orderkey % 7")),
        ("num_rep_legal", f"CASE WHEN o_orderkey % 4 = 0 THEN {_s('c_custkey')} ELSE {NULL_TEXT} END"),
        ("nome_rep_legal", "o_orderpriority"),
        ("cod_qual_socio_rep_legal", _s("o_orderkey % 30")),
        ("faixa_etaria", _s("o_orderkey % 12")),
    ]


def raw_companies(D: Dialect):
    """customer -> empresas layout."""
    return [
        ("cnpj", _s("c_custkey")),
        ("razao_social", "' ' || c_name"),
        ("cod_natju", _s("c_nationkey")),
        ("cod_qual_socio", _s("c_custkey % 7")),
        ("capital_social", f"CASE WHEN c_custkey % 11 = 0 THEN '1.' || replace({_s('c_acctbal')}, '.', ',') "
                           f"ELSE replace({_s('c_acctbal')}, '.', ',') END"),
        ("porte", _s("c_custkey % 7")),
        ("ente_fed_resp", "c_mktsegment"),
    ]


def raw_establishments(D: Dialect):
    """lineitem JOIN part JOIN supplier -> estab layout (30 columns)."""
    ymd = D.ymd("l_shipdate")
    return [
        ("cnpj", _s("l_orderkey")),
        ("cnpj_ordem", f"lpad({_s('l_linenumber')}, 4, '0')"),
        ("cnpj_dv", f"lpad({_s('l_suppkey % 100')}, 2, '0')"),
        ("id_matriz", _s("l_linenumber % 4")),
        ("nome_fantasia", "p_name"),
        ("situacao_cadastral", _s("l_linenumber")),
        ("data_situacao_cadastral", f"CASE WHEN l_orderkey % 7 = 0 THEN '00000000' ELSE {ymd} END"),
        ("motivo_situacao_cadastral", f"CASE WHEN l_orderkey % 11 = 0 THEN 'x' ELSE {_s('l_quantity')} END"),
        ("nome_cidade_ext", "s_name"),
        ("cod_pais", _s("l_linenumber")),
        ("data_inicio_atividades", ymd),
        ("cnae_primario", _s("l_partkey")),
        ("cnae_secundario", "p_type"),
        ("tipo_logradouro", "lower(p_type)"),
        ("logradouro", "p_name"),
        ("numero", f"CASE l_returnflag WHEN 'R' THEN 'S/N' WHEN 'A' THEN 'S/N B' ELSE {_s('l_linenumber')} END"),
        ("complemento", "p_brand"),
        ("bairro", "s_name"),
        ("cep", f"lpad({_s('l_suppkey')}, 8, '0')"),
        ("uf", "lower(l_linestatus) || ' '"),
        ("cod_mun", f"CASE WHEN l_orderkey % 9 = 0 THEN '99' ELSE {_s('s_nationkey')} END"),
        ("ddd_1", _s("l_suppkey % 90 + 10")),
        ("telefone_1", _s("l_partkey")),
        ("ddd_2", NULL_TEXT),
        ("telefone_2", NULL_TEXT),
        ("ddd_fax", NULL_TEXT),
        ("fax", NULL_TEXT),
        ("correio_eletronico", f"' ' || upper(p_brand) || {Q} || p_type || '.COM '"),
        ("situacao_especial", NULL_TEXT),
        ("data_situacao_especial", f"CASE WHEN l_orderkey % 5 = 0 THEN {ymd} ELSE {NULL_TEXT} END"),
    ]


# ---- labour flows -------------------------------------------------------------------------------------

# codebook name -> (source table, code expression over events, used by 'mov')
MOV_CODES = {
    "regiao": ("region", _s("user_id % 7")),
    "uf": ("nation", _s("user_id % 30")),
    "municipio": ("municipio", _s("user_id % 30")),
    "secao": ("region", _s("event_id % 6")),
    "subclasse": ("nation", _s("event_id % 27")),
    "fonte": ("region", _s("user_id % 3")),
    "categoria": ("region", _s("user_id % 5")),
    "cbo_ocupacao": ("nation", _s("event_id % 11")),
    "grau_instrucao": ("region", _s("event_id % 8")),
    "sexo": ("region", _s("event_id % 2")),
    "tipo_empregador": ("region", _s("user_id % 4")),
    "tipo_estab": ("nation", _s("user_id % 26")),
    "tipo_mov": ("region", _s("event_id % 9")),
    "ind_trab_parcial": ("region", _s("event_id % 3")),
    "ind_trab_intermitente": ("region", _s("user_id % 2")),
    "tipo_deficiencia": ("nation", _s("event_id % 29")),
    "raca": ("region", _s("user_id % 6")),
    "ind_aprendiz": ("region", _s("event_id % 4")),
    "tamanho_estab": ("nation", _s("user_id % 25")),
}


def codebook_rows(name: str, source: str):
    """Codebook ``(cod_<name>, <name>)`` as text from nation/region; 'municipio' labels look like 'UF-Name'."""
    if source == "region":
        return [(f"cod_{name}", _s("r_regionkey")), (name, "r_name")]
    if source == "nation":
        return [(f"cod_{name}", _s("n_nationkey")), (name, "n_name")]
    label = ("CASE WHEN n_nationkey % 5 = 0 THEN 'RJ-' || n_name || '-sai' "
             "WHEN n_nationkey % 7 = 0 THEN n_name ELSE 'SP-' || lower(n_name) END")
    return [(f"cod_{name}", _s("n_nationkey")), (name, label)]


def codebook_table(source: str) -> str:
    return "region" if source == "region" else "nation"


def raw_movements(D: Dialect):
    """events -> movement file layout with the accented headers."""
    c = {n: e for n, (_, e) in MOV_CODES.items()}
    return [
        ("competência", D.ym("ts")),
        ("região", c["regiao"]),
        ("uf", c["uf"]),
        ("município", c["municipio"]),
        ("seção", c["secao"]),
        ("subclasse", c["subclasse"]),
        ("saldomovimentação", "CASE WHEN event_type IN ('click', 'purchase') THEN '1' ELSE '-1' END"),
        ("cbo2002ocupação", c["cbo_ocupacao"]),
        ("categoria", c["categoria"]),
        ("graudeinstrução", c["grau_instrucao"]),
        ("idade", _s("event_id % 90")),
        ("horascontratuais", _s("value")),
        ("raçacor", c["raca"]),
        ("sexo", c["sexo"]),
        ("tipoempregador", c["tipo_empregador"]),
        ("tipoestabelecimento", c["tipo_estab"]),
        ("tipomovimentação", c["tipo_mov"]),
        ("tipodedeficiência", c["tipo_deficiencia"]),
        ("indtrabintermitente", c["ind_trab_intermitente"]),
        ("indtrabparcial", c["ind_trab_parcial"]),
        ("salário", f"CASE WHEN event_id % 10 = 0 THEN replace({_s('value')}, '.', ',') ELSE {_s('value')} END"),
        ("tamestabjan", c["tamanho_estab"]),
        ("indicadoraprendiz", c["ind_aprendiz"]),
        ("fonte", c["fonte"]),
        ("unidadesaláriocódigo", _s("event_id % 5")),  # a header the layout does not use
    ]


ESTAB_FLOW_CODES = {
    "regiao": ("region", _s("c_nationkey % 7")),
    "uf": ("nation", _s("c_nationkey")),
    "municipio": ("municipio", _s("o_custkey % 30")),
    "secao": ("region", _s("o_orderkey % 6")),
    "subclasse": ("nation", _s("o_orderkey % 27")),
    "tipo_empregador": ("region", _s("o_custkey % 4")),
    "tipo_estab": ("nation", _s("o_custkey % 26")),
    "tamanho_estab": ("nation", _s("o_orderkey % 25")),
    "fonte": ("region", _s("o_orderkey % 3")),
}


def raw_estab_flows(D: Dialect):
    """orders JOIN customer -> per-establishment flow layout."""
    c = {n: e for n, (_, e) in ESTAB_FLOW_CODES.items()}
    return [
        ("competência", D.ym("o_orderdate")),
        ("região", c["regiao"]),
        ("uf", c["uf"]),
        ("município", c["municipio"]),
        ("seção", c["secao"]),
        ("subclasse", c["subclasse"]),
        ("admitidos", _s("o_orderkey % 20")),
        ("desligados", _s("o_custkey % 15")),
        ("saldomovimentação", _s("o_orderkey % 20 - o_custkey % 15")),
        ("tipoempregador", c["tipo_empregador"]),
        ("tipoestabelecimento", c["tipo_estab"]),
        ("tamestabjan", c["tamanho_estab"]),
        ("fonte_desl", c["fonte"]),
    ]


# ---- ingestion ----------------------------------------------------------------------------------------

def listing_lines(D: Dialect):
    """events -> FTP-style listing lines, folder = event type."""
    return [
        ("event_id", "event_id"),
        ("folder", "event_type"),
        ("line", f"{D.listing_stamp('ts')} || '       <DIR>          ' || 'REL' || {_s('event_id % 97')}"),
    ]


def release_tree(D: Dialect):
    """orders -> release trees: year folders listed at each root, month folders in each year, files in each month.

    The stamp of a folder is the date of an order in it; each order yields one line at each level."""
    year, month = D.fmt("o_orderdate", "yyyy", "%Y"), D.fmt("o_orderdate", "MM", "%m")
    stamp = D.listing_stamp("o_orderdate")
    # One root per order priority: the same year and month names lie below each of them.
    root = "'ftp/' || replace(o_orderpriority, ' ', '_')"
    return {
        "years": [("folder", root), ("line", f"{stamp} || '       <DIR>          ' || {year}")],
        "months": [("folder", f"{root} || '/' || {year}"), ("line", f"{stamp} || '       <DIR>          ' || {month}")],
        "files": [("folder", f"{root} || '/' || {year} || '/' || {month}"), ("line", f"{stamp} || '       ' || {_s('o_orderkey % 9')} || ' F' || {_s('o_orderkey')} || '.zip'")],
    }


def deep_listing(D: Dialect):
    """orders -> folder ``root`` and entries (below, line): trees as deep as the root's number, one to five.

    Every order lists a folder at each level of its tree and a file in the lowest one; the stamp is the order's
    date shifted by the level, so levels have newest entries of their own."""
    depth = "(o_orderkey % 5 + 1)"
    names = [D.fmt("o_orderdate", "yyyy", "%Y"), D.fmt("o_orderdate", "MM", "%m"), D.fmt("o_orderdate", "dd", "%d"),
             _s("o_orderkey % 3"), _s("o_custkey % 4")]
    entries = []
    for level, name in enumerate(names):
        below = " || '/' || ".join(names[:level]) or NULL_TEXT
        stamp = D.listing_stamp("o_orderdate")
        line = f"CASE WHEN {level} < {depth} THEN {stamp} || '   <DIR>   ' || {name} WHEN {level} = {depth} THEN {stamp} || '  12 file.zip' END"
        entries.append((below, line))
    return [("folder", f"'deep/' || {_s('o_orderkey % 5')}"), ("lines", D.structs(entries))]


# References of every kind: relative, rooted, with dots, without a path, of another host, scheme or case.
REFERENCES = (
    "a/../b/./c.zip", "../../../up.zip", "./", "..", "/rooted/../x", "?page=3", "#part", "", "//Other.Example.com:80/a/..", "g;x=1/./y",
    "HTTP://User@EXAMPLE.com:80", "https://example.com:443/%7euser/%c3%a9?q=%41", "mailto:A@b.c/../d", " für/ein text.zip ", "%zz%2f%2E", "x?y=/../z#/../w",
)


# The sheet names as they appear in the layout workbook (mixed case), plus two sheets
# that are not codebooks.
WORKBOOK_SHEETS = (
    "Região", "UF", "Município", "Seção", "Subclasse", "fonte_desl", "Categoria", "CBO2002Ocupação",
    "GraudeInstrução", "Sexo", "TipoEmpregador", "TipoEstabelecimento", "TipoMovimentação", "IndTrabParcial",
    "IndTrabIntermitente", "TipodeDeficiência", "RaçaCor", "IndicadorAprendiz", "TamEstabJan",
    "Notas", "Layout",
)


def long_codebook(D: Dialect):
    """customer -> long codebook rows (sheet, code, description)."""
    whens = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(WORKBOOK_SHEETS))
    return [
        ("sheet", f"CASE c_custkey % {len(WORKBOOK_SHEETS)} {whens} END"),
        ("code", _s("c_custkey")),
        ("description", "c_name"),
    ]


def addresses(D: Dialect):
    """customer JOIN nation JOIN region -> addresses to match."""
    return [
        ("c_custkey", "c_custkey"),
        ("rua", f"'Rua ' || {_s('c_custkey % 40')}"),
        ("cep", f"lpad({_s('c_custkey % 30')}, 8, '0')"),
        ("bairro", f"'Bairro ' || {_s('c_custkey % 10')}"),
        ("municipio", "n_name"),
        ("uf", "r_name"),
    ]


def misspelt_addresses(D: Dialect):
    """The same addresses as people write them: other case and signs, a word more, a word less."""
    rows = dict(addresses(D))
    rows["rua"] = (f"CASE c_custkey % 4 WHEN 0 THEN 'Rua ' || {_s('c_custkey % 40')} WHEN 1 THEN 'RÚA - ' || {_s('c_custkey % 40')} || '.' "
                   f"WHEN 2 THEN 'Rua ' || {_s('c_custkey % 40')} || ' fundos' ELSE {_s('c_custkey % 40')} END")
    rows["bairro"] = f"CASE WHEN c_custkey % 3 = 0 THEN {_s('c_custkey % 10')} || ' bairro' ELSE 'Bairro ' || {_s('c_custkey % 10')} END"
    return list(rows.items())


def gazetteer(D: Dialect):
    """supplier JOIN nation JOIN region -> candidates at three grains (one SELECT per grain)."""
    city = "n_name || ', ' || r_name"
    common = [
        ("lat", "s_acctbal / 100.0"),
        ("lng", "CAST(-(s_suppkey % 90) AS DOUBLE)"),
        ("score", "CAST(70 + s_suppkey % 31 AS INT)"),
        ("quality", "CASE s_suppkey % 3 WHEN 0 THEN 'PointAddress' WHEN 1 THEN 'StreetAddress' ELSE 'Locality' END"),
    ]
    found = f"CASE WHEN s_suppkey % 6 = 0 THEN 'Somewhere Else' ELSE 'Result near ' || {city} END"
    return {
        "address": [("grain", "'address'"),
                    ("key", f"'Rua ' || {_s('s_suppkey % 40')} || ', Bairro ' || {_s('s_suppkey % 10')} || ', ' || {city}"),
                    ("matched_address", found)] + common,
        "district": [("grain", "'district'"),
                     ("key", f"'Bairro ' || {_s('s_suppkey % 10')} || ', ' || {city}"),
                     ("matched_address", found)] + common,
        "zip": [("grain", "'zip'"),
                ("key", f"lpad({_s('s_suppkey % 30')}, 8, '0') || ', ' || {city}"),
                ("matched_address", found)] + common,
    }


def documents_positional(D: Dialect):
    """documents -> positional rows with the whole text, its line breaks written as ``\\n`` and ``\\r``
    (and a backslash as two), so that a row is a line of the file and nothing is lost."""
    escaped = "replace(replace(replace(text, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r')"
    return [
        ("doc_id", _s("doc_id")),
        ("texto", escaped),
        ("lang", "lang"),
        ("source", "source"),
        ("n_chars", _s("n_chars")),
    ]


def order_lines(D: Dialect):
    """orders -> lines of a dump of four columns: every tenth row short, long or broken, some with quoted separators."""
    key, day = _s("o_orderkey"), D.ymd("o_orderdate")
    rows = {
        0: "{key} || ';' || o_orderpriority",
        1: "{key} || ';' || o_orderpriority || ';' || o_orderstatus || ';' || {day} || ';more;'",
        2: "{key} || ';\"' || o_orderpriority || ';' || o_orderstatus || ';' || {day}",
        3: "{key} || ';\"a;b \"\"' || o_orderpriority || '\"\"\";' || o_orderstatus || ';' || {day}",
        4: "{key} || ';5\" of it;' || o_orderstatus || ';'",
    }
    whens = " ".join(f"WHEN {k} THEN {row.format(key=key, day=day)}" for k, row in rows.items())
    return [("value", f"CASE o_orderkey % 10 {whens} ELSE {key} || ';' || o_orderpriority || ';' || o_orderstatus || ';' || {day} END")]
