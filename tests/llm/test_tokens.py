"""Token output, counting and packing against the libraries and by round trip."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadastro.llm import arrow_sequences, packing, token_counts, tokens
from tests.llm.conftest import DOCS, TEXTS, by_id

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
LIBRARY = {f: Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES}
SPEC = {f: tokens.read_tokenizer(public_tokenizers.path(f)) for f in FILES}


def library_ids(file, text):
    return LIBRARY[file].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("file", FILES)
def test_encoder_gives_the_library_ids(file):
    encoder = tokens.Encoder(SPEC[file], cache_pieces=50)
    for _ in range(2):  # the second time from the caches, which overflow
        for text in TEXTS:
            assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == library_ids(file, text)


ALPHABET = st.sampled_from(list("aBé ß'\n\t .,!<|>0 5x²½ª ́  ᠎​日😀\x1c\x85"))


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=100, deadline=None)
@given(text=st.lists(st.one_of(ALPHABET, st.sampled_from(["'s", " the", "<|endoftext|>", "  ", " x", "\r\n"])), max_size=25).map("".join))
def test_encoder_on_random_texts(file, text):
    encoder = tokens.encoder(SPEC[file])
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == library_ids(file, text)


def test_long_texts_are_cut_only_where_no_token_crosses(monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT_CHARS", 40)
    monkeypatch.setattr(tokens._segments, "__defaults__", (40,))
    text = "some words, a tab\there and  two blanks; 'tis x " * 20
    for file in FILES:
        encoder = tokens.Encoder(SPEC[file])
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == library_ids(file, text)


def test_sequences_round_trip(spark, odd_docs, tmp_dir):
    folder = f"{tmp_dir}/out"
    clash = odd_docs.withColumn("tie", odd_docs.n_chars).withColumn("ID", odd_docs.n_chars)
    arrow_sequences.write_sequences(clash, folder, SPEC[FILES[0]], seq_len=64, batch_sequences=4)
    rows = sorted(arrow_sequences.read_documents(spark, folder).collect(), key=lambda r: r.start)
    docs = sorted((r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect() if r.text is not None)
    assert len(rows) == odd_docs.count() and [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    expected = {(d, zlib.crc32(np.array(library_ids(FILES[0], t) + [0], "<u4").tobytes())) for d, t in docs}
    assert expected <= {(r.doc_id, r.ids_crc32) for r in rows}
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:])) and rows[0].start == 0
    for m in arrow_sequences.read_manifest(spark, folder).collect():
        reader = arrow_sequences.SequenceReader(folder, m.sequences_file)
        kept = 0
        for s in range(m.n_sequences):
            ids, mask = reader.sequence(s)
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata
            kept += mask.true_count
        assert kept == m.n_tokens
        stream = np.concatenate(list(reader.stream(0, m.n_tokens)))
        assert len(stream) == m.n_tokens
        first = pa.ipc.open_file(pa.memory_map(f"{folder}/{m.sequences_file}")).schema.field("ids").type
        assert pa.types.is_fixed_size_list(first)


def test_sequences_of_an_empty_table(spark, no_docs, tmp_dir):
    folder = f"{tmp_dir}/none"
    assert arrow_sequences.write_sequences(no_docs, folder, SPEC[FILES[0]]).count() == 0
    assert arrow_sequences.read_documents(spark, folder).count() == 0


def test_counts_equal_the_library(spark, odd_docs, no_docs):
    clash = odd_docs.withColumn("N_TOKENS", odd_docs.n_chars)
    counted = token_counts.count_tokens(clash, SPEC[FILES[0]], limit=3, table={" the": 1}, cache_size=5)
    assert [c for c in counted.columns if c.lower() == "n_tokens"] == ["n_tokens"]
    assert counted.count() == len(TEXTS)
    for r in counted.collect():
        n = len(library_ids(FILES[0], r.text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 3)
    assert token_counts.count_tokens(no_docs, SPEC[FILES[0]]).count() == 0


def test_table_holds_the_most_frequent_pretokens_of_all_documents(spark, odd_docs, no_docs):
    """Against the library's own pre-tokenizer and counts, over texts of every script."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    more = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(["“curly” quotes – and – dashes…", "日本語 のテキスト", "слово и слово"] * 9)], DOCS)
    docs = odd_docs.unionByName(more)
    counts = Counter()
    for r in docs.collect():
        if r.text and "<|" not in r.text:
            counts.update(r.text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(r.text))
    want = sorted((x for x in counts.items()), key=lambda x: (-x[1], x[0].encode()))
    table = token_counts.fit_table(docs, SPEC[FILES[0]], table_size=1 << 15)
    assert set(table) == {w for w, _ in want if len(w) <= 64}
    assert all(n == len(tokenizer.encode(w, add_special_tokens=False).ids) for w, n in table.items())
    small = token_counts.fit_table(docs, SPEC[FILES[0]], table_size=40)
    assert len(small) == 40 and min(counts[w] for w in small) >= want[60][1]
    for fitted in (table, small):
        for r in token_counts.count_tokens(docs, SPEC[FILES[0]], table=fitted).collect():
            assert r.n_tokens == len(library_ids(FILES[0], r.text))
    assert token_counts.fit_table(no_docs, SPEC[FILES[0]]) == {}
    assert token_counts.fit_table(docs, SPEC[FILES[1]]) == {}


def test_counts_by_a_sentencepiece_model(odd_docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in token_counts.count_tokens_sentencepiece(odd_docs, path).collect():
        assert r.n_tokens == len(model.encode(r.text or ""))


def first_fit(counts, capacity):
    """Sequences that plain first-fit decreasing needs, piece by piece."""
    gaps = []
    for size in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
        for k, gap in enumerate(gaps):
            if gap >= size:
                gaps[k] -= size
                break
        else:
            gaps.append(capacity - size)
    return len(gaps)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_plan_places_every_piece_once(counts):
    plan = packing.plan_packing(counts, 30)
    used = defaultdict(list)
    for size, n in counts.items():
        sequence, offset = plan.place(np.full(n, size), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            used[s].append((o, size))
    for parts in used.values():
        at = 0
        for o, size in sorted(parts):
            assert o == at
            at += size
        assert at <= 30 and sum(size > 10 for _, size in parts) <= 2
    assert len(used) == plan.n_sequences
    assert plan.n_sequences <= first_fit(counts, 30) * 1.05 + 1


def test_pack_round_trip(spark, odd_docs, no_docs):
    spec = SPEC[FILES[1]]
    packed = packing.pack(odd_docs.withColumn("RANK", odd_docs.n_chars), spec, capacity=256)
    rows = packed.collect()
    ids = {id(r): np.frombuffer(r.ids, "<u4").tolist() for r in rows}
    texts = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert sum(r.length for r in rows) == sum(len(library_ids(FILES[1], t)) + 1 for _, t in texts)
    once = {d: t for d, t in texts if sum(x == d for x, _ in texts) == 1}
    for d, t in once.items():
        own = sorted((r for r in rows if r.doc_id == d), key=lambda r: r.piece)
        assert sum((ids[id(r)] for r in own), []) == library_ids(FILES[1], t) + [0]
        assert all(r.length == 256 for r in own[:-1]) and [r.start for r in own] == [256 * r.piece for r in own]
    whole = by_id(packing.sequences(packed), "sequence_id")
    for s, r in whole.items():
        parts = sorted((x for x in rows if x.sequence_id == s), key=lambda x: x.offset)
        assert r.ids == b"".join(bytes(x.ids) for x in parts) and r.length <= 256
    assert packing.pack(no_docs, spec).count() == 0


def test_token_ids_are_never_shuffled(odd_docs):
    """The scan of the pieces meets the tasks' rows in its own buckets, whatever their number."""
    packed = packing.pack(odd_docs, SPEC[FILES[1]], capacity=256)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    side = plan.split("ShuffledHashJoin")[1].split("+- Exchange")[0]
    assert "Bucketed: true" in side and "ids" in side and "Exchange" not in side
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan
