"""Personal data in texts: base patterns, and a skip-chain conditional random field that adds to them.

Base patterns find e-mail addresses, IP addresses, card numbers and phone numbers that are written out
in full. The same number often comes back in another form (without its country code, with other
separators), which no pattern can tell from any other number. The field can:

1. Nodes are the words of a text that hold a digit or an ``@``; any other word can carry no label and is
   fixed to none, which takes it out of the model without changing it. A node's label is one of the
   kinds, or none.
2. Potentials: hashed features of a word (its shape, digits, neighbours) with each label; labels of
   adjacent nodes; and labels of two nodes however far apart if their texts are the same or similar (equal
   digits, the same seven last or first digits, the same name before an ``@``). Each later node of a group of
   equal keys is joined to the group's first, so a group of k words has k - 1 skip edges.
3. Words inside base matches are clamped to their kind. Loopy belief propagation then passes messages over
   all edges of a text at once, for a fixed number of rounds, and so carries a label to distant mentions.
   Unclamped words with a marginal of ``threshold`` or more for a kind become spans.

The weights are learned by pseudo-likelihood from the base matches of a bounded sample of texts
(``fit_documents``), to which variants of their matches (labelled) and numbers of the same shapes
(without label) are appended; everything else works on all texts, whole.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import append_columns, slices

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = len(KINDS) + 1
FEATURES = 4096
ROUNDS = 20
THRESHOLD = 0.8
FIT_DOCUMENTS = 4000
_FIT_NODES = 64  # of a sampled document

# A match can only begin at a digit run's first digit, as any later one would meet the same end.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NODE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_SIGNAL = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_EDGE_SIGNS = ".,;:!?\"'*#$%&|[]{}<>"


def luhn(digits: str) -> bool:
    """Whether the digits' check sum holds."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str):
    """(start, end): for each ``@`` the longest name before it, from the end of the last match on."""
    start, at = 0, text.find("@")
    while at >= 0:
        before = at
        while before > start:  # back to the name's first character, a stretch at a time
            stretch = text[max(start, before - 64):before]
            signs = [m.end() for m in _NOT_LOCAL.finditer(stretch)]
            if signs:
                before += signs[-1] - len(stretch)
                break
            before -= len(stretch)
        domain = _DOMAIN.match(text, at + 1) if before < at else None
        if domain:
            yield before, domain.end()
            start = domain.end()
        else:
            start = at + 1
        at = text.find("@", start)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches, sorted; leftmost and without overlap within a kind."""
    if not _SIGNAL.search(text):
        return []
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in (g.lstrip("0") for g in m.groups())):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _bucket(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}:{value}".encode()) % (FEATURES - 1) + 1


_DIGIT_RUN, _LETTER_RUN = re.compile(r"[0-9]+"), re.compile(r"[^\W\d_]+")


def _features(word: str, before: str, after: str) -> list[int]:
    """Hashed features of a node; 0 is common to all."""
    core = word.strip(_EDGE_SIGNS)
    letters = _LETTER_RUN.sub("a", core)
    digits = _NOT_DIGIT.sub("", core)
    parts = core.split(".")
    address = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    return [0, _bucket("shape", _DIGIT_RUN.sub(lambda m: "9" * min(20, len(m.group())), letters)), _bucket("coarse", _DIGIT_RUN.sub("9", letters)),
            _bucket("digits", str(min(20, len(digits)))), _bucket("luhn", str(14 <= len(digits) <= 19 and luhn(digits))),
            _bucket("address", str(address)), _bucket("at", str("@" in core)), _bucket("before", before.lower()), _bucket("after", after.lower())]


def _keys(word: str, run: str):
    """(edge type, key) pairs by which a node is joined to others: type 1 the same, type 2 similar. ``run``:
    the digits of the adjacent nodes up to this one."""
    core = word.strip(_EDGE_SIGNS).lower()
    digits = _NOT_DIGIT.sub("", core)
    if len(digits) >= 3:
        yield 1, core
    # A number may be written as several words: its last word speaks for all of it.
    for number in dict.fromkeys((digits, run)):
        if len(number) >= 4 and len(digits) > len(core) / 2:
            yield 1, f"#{number}"
        if len(number) >= 7:
            yield 2, f"<{number[:7]}"
            yield 2, f">{number[-7:]}"
    name = core.split("@")[0] if "@" in core else core
    if len(name) >= 5 and any(c.isalpha() for c in name):
        yield 2, f"@{name}"


@dataclass
class Graph:
    """Nodes of a text: places, features, the label of the base match each is in (or none), and edges."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    labels: np.ndarray
    edges: np.ndarray  # columns: node, node, type (0 adjacent, 1 the same, 2 similar)


def graph(text: str, base: list[tuple[int, int, int]]) -> Graph:
    """The skip-chain graph of a whole text."""
    places, features, labels, edges = [], [], [], []
    first: dict[tuple[int, str], int] = {}
    at, run = 0, ""
    reach: list[int] = []  # furthest end of the base matches up to each
    for _, _, e in base:
        reach.append(max(e, reach[-1] if reach else 0))
    for m in _NODE.finditer(text):
        s, e, node = m.start(), m.end(), len(places)
        before = text[max(0, s - 32):s].split()[-1:] or [""]
        after = text[e:e + 32].split()[:1] or [""]
        places.append((s, e))
        features.append(_features(m.group(), before[0], after[0]))
        while at < len(base) and reach[at] <= s:
            at += 1
        inside = [kind for start, kind, end in _from(base, at, e) if end > s]
        labels.append(min(inside, default=NONE))
        digits = _NOT_DIGIT.sub("", m.group())
        if node and text[places[-2][1]:s].isspace():
            edges.append((node - 1, node, 0))
            run = run + digits if len(run) + len(digits) <= 19 else digits
        else:
            run = digits
        joined = set()
        for kind, key in _keys(m.group(), run):
            other = first.setdefault((kind, key), node)
            if other != node and other not in joined:
                joined.add(other)
                edges.append((other, node, kind))
    return Graph(places, np.array(features, np.int32).reshape(-1, 9), np.array(labels, np.int64), np.array(edges, np.int64).reshape(-1, 3))


def _from(base: list, at: int, end: int):
    while at < len(base) and base[at][0] < end:
        yield base[at]
        at += 1


@dataclass
class Field:
    """Weights: ``unary`` (feature, label) and ``pairs`` (edge type, label, label)."""

    unary: np.ndarray
    pairs: np.ndarray


def marginals(unary: np.ndarray, edges: np.ndarray, pairs: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Loopy belief propagation: label probabilities of every node, exact where the edges form trees of a
    diameter below ``rounds``. ``rounds`` is fixed, so a text's result does not depend on others beside it."""
    if len(edges):
        n = len(edges)
        src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        table = np.concatenate([pairs[edges[:, 2]], pairs[edges[:, 2]].transpose(0, 2, 1)])
        back = np.concatenate([np.arange(n) + n, np.arange(n)])
        messages = np.zeros((2 * n, LABELS))
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, dst, messages)
            new = _logsum((belief[src] - messages[back])[:, :, None] + table, 1)
            messages = new - _logsum(new, 1)[:, None]
        unary = unary.copy()
        np.add.at(unary, dst, messages)
    return np.exp(unary - _logsum(unary, 1)[:, None])


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def tag(g: Graph, text: str, field: Field, threshold: float = THRESHOLD) -> list[tuple[int, int, int]]:
    """Spans the field adds: runs of adjacent nodes outside base matches, of one kind each."""
    free = g.labels == NONE
    if not free.any():
        return []
    unary = field.unary[g.features].sum(axis=1)
    clamped = np.where(np.arange(LABELS)[None, :] == g.labels[:, None], 0.0, -100.0)
    p = marginals(np.where(free[:, None], unary, clamped), g.edges, field.pairs)
    kind = np.where(free & (p[:, :NONE].max(axis=1) >= threshold), p[:, :NONE].argmax(axis=1), NONE)
    found: list[tuple[int, int, int]] = []
    for node in np.flatnonzero(kind != NONE).tolist():
        s, e = g.spans[node]
        # One mention goes on over a blank, not over a sign that ends a clause.
        if node and kind[node - 1] == kind[node] and text[g.spans[node - 1][1]:s].isspace() and text[g.spans[node - 1][1] - 1] not in ".,;:!?":
            s = found.pop()[0]
        found.append((s, int(kind[node]), e))
    out = []
    for s, k, e in found:
        while s < e and not (text[s].isalnum() or text[s] in "+("):
            s += 1
        while e > s and not (text[e - 1].isalnum() or text[e - 1] == ")"):
            e -= 1
        if e > s:
            out.append((s, k, e))
    return out


def _variants(value: str, kind: int) -> list[str]:
    """Other ways in which a text may come back to a base match; none of them is one itself."""
    digits = _NOT_DIGIT.sub("", value)
    if kind == 0:
        return [value.split("@")[0]]
    if kind == 1:
        return [value.replace(".", "-")]
    if kind == 2:
        return [".".join(digits[i:i + 4] for i in range(0, len(digits), 4))]
    return [f"{digits[-7:-4]}-{digits[-4:]}", f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", digits[-10:]]


def _example(text: str) -> Graph:
    """A sampled text with variants of its base matches (labelled) and numbers of the same shape (not)."""
    base = base_spans(text)
    window = graph(text, base)
    keep = max(1, min(_FIT_NODES, len(window.spans)))
    parts, labelled = [text[:window.spans[keep - 1][1]] if window.spans else ""], []
    size = len(parts[0])
    for k, (s, kind, e) in enumerate([b for b in base if b[2] <= size][:16]):
        # One variant of each match: two of them would vouch for each other.
        variants = _variants(text[s:e], kind)
        value = variants[(zlib.crc32(text.encode()) + k) % len(variants)]
        # One number that comes twice and one that comes once, with no match to go back to.
        twice, once = (re.sub(r"[0-9]", lambda m, a=a: str((int(m.group()) * 7 + k * a + m.start() + 1) % 10), value) for a in (3, 9))
        for piece, of in ((value, kind), (twice, None), (twice, None), (once, None)):
            parts += [" so ", piece]
            size += 4 + len(piece)
            if of is not None:
                labelled.append((size - len(piece), of, size))
    whole = "".join(parts)
    return graph(whole, sorted([*base_spans(whole), *labelled]))


def fit(docs: DataFrame, *, text_col: str = "text", fit_documents: int = FIT_DOCUMENTS, steps: int = 500) -> Field:
    """Weights from at most ``fit_documents`` texts that hold a digit or an ``@`` (those of the smallest hashes).

    The tasks send graphs of at most 64 words of each sampled text and their variants. Without any example
    all weights are 0 and nothing is added to the base matches.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    h = F.xxhash64("text")
    chosen = texts.select(h.alias("h")).distinct().orderBy("h").limit(fit_documents)
    # The hash below which the sample lies: one number, so the texts themselves are picked where they are.
    edge = chosen.agg(F.max("h")).first()[0]
    if edge is None:
        return Field(np.zeros((FEATURES, LABELS)), np.zeros((3, LABELS, LABELS)))

    def run(batches):
        for batch in batches:
            for _, part in slices(batch, 0):
                graphs = [_example(t) for t in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([zlib.crc32(t.encode()) for t in part], pa.int64()), pa.array([g.features.astype("<i4").tobytes() for g in graphs]),
                     pa.array([g.labels.astype("<i8").tobytes() for g in graphs]), pa.array([g.edges.astype("<i8").tobytes() for g in graphs])],
                    names=["h", "features", "labels", "edges"])

    rows = texts.where(h <= edge).dropDuplicates(["text"]).mapInArrow(run, "h long, features binary, labels binary, edges binary").collect()
    rows.sort(key=lambda r: (r.h, r.features))
    features = [np.frombuffer(bytes(r.features), "<i4").reshape(-1, 9) for r in rows]
    labels = [np.frombuffer(bytes(r.labels), "<i8") for r in rows]
    edges = [np.frombuffer(bytes(r.edges), "<i8").reshape(-1, 3) for r in rows]
    opens = np.cumsum([0, *(len(x) for x in labels)])
    shifted = [e + np.array([[o, o, 0]]) for e, o in zip(edges, opens[:-1], strict=True)]
    return learn(np.concatenate(features), np.concatenate(labels), np.concatenate(shifted), steps)


def learn(features: np.ndarray, labels: np.ndarray, edges: np.ndarray, steps: int = 500, decay: float = 1e-5) -> Field:
    """Pseudo-likelihood: each node's label given its features and its neighbours' labels, by full-batch
    gradient steps scaled per weight (Adam), which are the same on every run."""
    used, columns = np.unique(features, return_inverse=True)
    columns = columns.reshape(features.shape)
    unary, pairs = np.zeros((len(used), LABELS)), np.zeros((3, LABELS, LABELS))
    n, y = len(labels), np.eye(LABELS)[labels]
    i, j, t = edges.T
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in (unary, pairs)]
    for step in range(1, steps + 1):
        logits = unary[columns].sum(axis=1)
        np.add.at(logits, i, pairs[t, :, labels[j]])
        np.add.at(logits, j, pairs[t, labels[i], :])
        gap = (np.exp(logits - _logsum(logits, 1)[:, None]) - y) / n
        down_unary = np.zeros_like(unary)
        for k in range(columns.shape[1]):
            for label in range(LABELS):
                down_unary[:, label] += np.bincount(columns[:, k], gap[:, label], len(used))
        down_pairs = np.zeros_like(pairs)
        np.add.at(down_pairs, t, gap[i][:, :, None] * y[j][:, None, :] + y[i][:, :, None] * gap[j][:, None, :])
        # The order of two words that are joined for their likeness says nothing.
        down_pairs[1:] += down_pairs[1:].transpose(0, 2, 1).copy()
        for w, down, (m, v) in zip((unary, pairs), (down_unary, down_pairs), moments, strict=True):
            down = down + decay * w
            m += 0.1 * (down - m)
            v += 0.01 * (down * down - v)
            w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    whole = np.zeros((FEATURES, LABELS))
    whole[used] = unary
    return Field(whole, pairs)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, field: Field | None = None, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus n_email, n_ip, n_card, n_phone (base matches), base_sha256 (of the base matches, written
    ``kind:start:end`` in code points and joined by commas), n_added and spans (base and added ones, written alike).

    Null text counts as empty; texts without a digit or an ``@`` have no span; repeated rows each get their
    own; an empty table gives an empty one; columns of the input with these names are replaced. A
    text's nodes (words with a digit or an ``@``) are held at once, texts one at a time; patterns run in time
    linear in the text. ``field``: weights, fitted on ``docs`` if none are given.
    """
    field = fit(docs, text_col=text_col) if field is None else field
    shipped = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        weights = shipped.value

        def compute(texts):
            counts, digests, added, written = np.zeros((len(texts), NONE), np.int64), [], np.zeros(len(texts), np.int64), []
            for row, text in enumerate(texts):
                base = base_spans(text or "")
                more = tag(graph(text, base), text, weights, threshold) if text and _SIGNAL.search(text) else []
                for _, kind, _ in base:
                    counts[row, kind] += 1
                added[row] = len(more)
                digests.append(hashlib.sha256(_written(base).encode()).hexdigest())
                written.append(_written(sorted([*base, *more])))
            return [*(pa.array(counts[:, k]) for k in range(NONE)), pa.array(digests), pa.array(added), pa.array(written)]

        return compute

    fields = [*((f"n_{k}", T.LongType()) for k in KINDS), ("base_sha256", T.StringType()), ("n_added", T.LongType()), ("spans", T.StringType())]
    return append_columns(docs.withColumn(text_col, F.col(text_col).cast("string")), make, fields, text_col)
