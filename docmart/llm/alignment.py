"""Alignment of two tokenizers by sparse incidence products.

Both tokenizers cut the same bytes. A block of texts gives two incidence matrices in compressed sparse
rows, built by hand with numpy: A has a row for each token of the first tokenizer and a column for each
byte, B the same for the second. Gustavson's row-by-row product A·Bᵀ has an entry for each pair of
tokens that share bytes, its value their number: the overlap links. Byte offsets where tokens of both
end cut a text into groups, the smallest stretches that both tokenizers cover with whole tokens. The
product of the two token-group incidence matrices gives the pairs that lie in one group: the shared-group
links. Overlap links whose tokens end at the same byte are the end links.

Everything about one text is made in one Arrow pass over the documents. What needs the whole corpus,
how often an id pair is linked, is counted per batch, summed by Spark and read back. The two tokens of an end
link end at the same byte, so the bytes of one are a suffix of the other's: the vocabularies bound the
number of id pairs (``suffix_pairs`` counts them, about a million at most for 50,000 and 32,000
pieces), whatever the corpus, so their table is broadcast.

Matrices are made for blocks of about ``_BLOCK`` bytes, cut at group ends (no link crosses one), so a
very long text needs no more memory than a short one but for its own tokens.
"""

from __future__ import annotations

import hashlib
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

SPACE = "▁"
_BLOCK = 1 << 19  # bytes of text in one matrix
KINDS = ("end", "overlap", "group")


# Compressed sparse rows: (indptr, indices, number of columns); all values are one ------------------

def incidence(starts: np.ndarray, ends: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows that hold the columns from their start up to their end."""
    indptr = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=indptr[1:])
    indices = np.arange(indptr[-1]) - np.repeat(indptr[:-1] - starts, ends - starts)
    return indptr, indices, columns


def transpose(m: tuple[np.ndarray, np.ndarray, int]) -> tuple[np.ndarray, np.ndarray, int]:
    indptr, indices, columns = m
    rows = np.repeat(np.arange(len(indptr) - 1), np.diff(indptr))
    order = np.argsort(indices, kind="stable")
    out = np.zeros(columns + 1, np.int64)
    np.cumsum(np.bincount(indices, minlength=columns), out=out[1:])
    return out, rows[order], len(indptr) - 1


def product(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int]) -> tuple[np.ndarray, ...]:
    """Gustavson's product of two matrices of ones: (row, column, value) in order of rows and columns.

    Each row of the result is the sum of the rows of ``b`` that the row of ``a`` names; the rows are laid
    out one behind the other and equal columns are added up.
    """
    indptr, indices, _ = a
    b_ptr, b_indices, columns = b
    size = np.diff(b_ptr)[indices]
    rows = np.repeat(np.repeat(np.arange(len(indptr) - 1), np.diff(indptr)), size)
    before = np.cumsum(size) - size
    key = rows * columns + b_indices[np.arange(len(rows)) - np.repeat(before - b_ptr[indices], size)]
    if len(key) and (key[1:] < key[:-1]).any():
        key = np.sort(key, kind="stable")
    first = np.flatnonzero(np.diff(key, prepend=-1))
    found = key[first]
    return found // columns, found % columns, np.diff(first, append=len(key))


# Tokenizers ----------------------------------------------------------------------------------------

class Pair:
    """Both tokenizers, and the bytes of each of their tokens.

    The byte-level tokenizer is run by tiktoken on the vocabulary, merges and pattern of its JSON file
    where ``fast`` finds that file of the shape it knows, else by the tokenizers library.
    """

    def __init__(self, a_json: bytes, b_model: bytes):
        import json

        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = json.loads(a_json)
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        vocab = spec["model"]["vocab"]
        added = {x["id"] for x in spec.get("added_tokens", [])}
        a = {i: bytes(byte_of[c] for c in piece) for piece, i in vocab.items() if i not in added}
        self.a_bytes = [a.get(i, b"") for i in range(max(vocab.values()) + 1)]
        self.encode_a = _fast(spec, a) or _library(a_json)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(b_model)
        normal, byte = 1, 6
        self.b_bytes = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == byte else p.piece.replace(SPACE, " ").encode() if p.type == normal
            else b"" for p in proto.pieces]
        self.a_size, self.b_size = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))
        # A token's number as text, before another token of its side, and before what follows its side.
        self.a_text = [f"{i}{mark}" for mark in ",|" for i in range(len(self.a_bytes))]
        self.b_text = [f"{i}{mark}" for mark in ",;" for i in range(len(self.b_bytes))]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides for each text; none where there is no text or a side does not give its bytes."""
        out = [(_NONE, _NONE)] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        found = self.b.encode([texts[i] for i in some], num_threads=1)
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for i, b in zip(some, found):
            raw = b" " + texts[i].encode()
            a = self.encode_a(" " + texts[i])
            if b"".join(map(a_bytes, a)) == raw and b"".join(map(b_bytes, b)) == raw:
                out[i] = np.array(a, np.int64), np.array(b, np.int64)
        return out


_NONE = np.empty(0, np.int64)


def byte_alphabet() -> list[str]:
    """The character a byte-level vocabulary writes for each byte: itself where it is visible in
    Latin-1, else the next character from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (chr(c) for c in range(256, 512))
    return [chr(b) if b in visible else next(rest) for b in range(256)]


#: FIXED: the pattern of the byte-level tokenizer, which its library has built in.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _fast(spec: dict, a: dict[int, bytes]):
    """The encoder as ranked merges: if every merge of the file makes the next id after the single bytes."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    plain = (model.get("type", "BPE") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
             and pre.get("use_regex", True) and not spec.get("normalizer") and not model.get("continuing_subword_prefix")
             and not model.get("end_of_word_suffix") and not model.get("ignore_merges") and not model.get("dropout"))
    if not plain or len(a) != 256 + len(merges) or any(len(a.get(i, b"")) != 1 for i in range(256)):
        return None
    if any(model["vocab"].get("".join(m)) != 256 + i for i, m in enumerate(merges)):
        return None
    import tiktoken

    return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks={x: i for i, x in a.items()},
                             special_tokens={}).encode_ordinary


def _library(a_json: bytes):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(a_json.decode())
    library.encode_special_tokens = True
    return lambda text: library.encode(text, add_special_tokens=False).ids


def suffix_pairs(pair: Pair) -> int:
    """How many id pairs can ever end together: one token's bytes are a suffix of the other's."""
    by_bytes: tuple[dict, dict] = ({}, {})
    for ids, side in zip(by_bytes, (pair.a_bytes, pair.b_bytes)):
        for x in side:
            if x:
                ids[x] = ids.get(x, 0) + 1
    a, b = by_bytes
    n = sum(k * b.get(x[i:], 0) for x, k in a.items() for i in range(len(x)))
    return n + sum(k * a.get(x[i:], 0) for x, k in b.items() for i in range(1, len(x)))


# Alignment -----------------------------------------------------------------------------------------

class Aligned:
    """Tokens of a block of texts, their groups, and their links by block-diagonal products."""

    def __init__(self, pair: Pair, ids: list[tuple[np.ndarray, np.ndarray]]):
        self.n_a, self.n_b = (np.array([len(x[side]) for x in ids], np.int64) for side in (0, 1))
        self.a, self.b = (np.concatenate([_NONE, *[x[side] for x in ids]]) for side in (0, 1))
        # The texts lie one behind the other; each has as many bytes on either side.
        self.a_end, self.b_end = np.cumsum(pair.a_size[self.a]), np.cumsum(pair.b_size[self.b])
        self.cuts = np.intersect1d(self.a_end, self.b_end, assume_unique=True)

    def groups(self, side: str) -> np.ndarray:
        """The group of each token of a side."""
        return np.searchsorted(self.cuts, self.a_end if side == "a" else self.b_end)

    def links(self, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a, b, weight): numbers of the linked tokens in the block, and the bytes they share (group: 1)."""
        out = [(_NONE,) * 3]
        at = 0
        while at < len(self.cuts):
            low = self.cuts[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(self.cuts, low + _BLOCK, "right")))
            high = self.cuts[to - 1]
            (a0, a1), (b0, b1) = (np.searchsorted(end, [low, high], "right") for end in (self.a_end, self.b_end))
            a_end, b_end = self.a_end[a0:a1] - low, self.b_end[b0:b1] - low
            if kind == "group":
                a, b = (np.searchsorted(self.cuts[at:to] - low, x) for x in (a_end, b_end))
                row, col, weight = product(incidence(a, a + 1, to - at), transpose(incidence(b, b + 1, to - at)))
            else:
                size = int(high - low)
                a, b = (incidence(np.concatenate([[0], x[:-1]]), x, size) for x in (a_end, b_end))
                row, col, weight = product(a, transpose(b))
                if kind == "end":
                    both = a_end[row] == b_end[col]
                    row, col, weight = row[both], col[both], weight[both]
            out.append((row + a0, col + b0, weight))
            at = to
        return tuple(np.concatenate(x) for x in zip(*out))

    def group_texts(self, pair: Pair) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text: ids of each group's tokens, '' without tokens."""
        a_group, b_group = self.groups("a"), self.groups("b")
        a_last, b_last = (np.diff(g, append=-1) != 0 for g in (a_group, b_group))
        a, b = self.a + len(pair.a_bytes) * a_last, self.b + len(pair.b_bytes) * b_last + len(pair.a_text)
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        names = pair.a_text + pair.b_text
        parts = list(map(names.__getitem__, np.concatenate([a, b])[order].tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(parts[i:j])[:-1] for i, j in zip([0, *ends], ends)]


def _pair(a_json: bytes, b_model: bytes) -> Pair:
    """Both tokenizers, once for the life of a worker (this module is sent by value with each task)."""
    held = sys.modules.setdefault("docmart_token_pairs", types.ModuleType("docmart_token_pairs")).__dict__
    key = hashlib.sha256(a_json).hexdigest() + hashlib.sha256(b_model).hexdigest()
    if key not in held:
        held[key] = Pair(a_json, b_model)
    return held[key]


def _blocks(texts: pa.Array):
    """Slices of a text column of about ``_BLOCK`` bytes, a very long text alone."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False), np.int64)
    ends, i = np.cumsum(sizes), 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + _BLOCK, "right")))
        yield i, j
        i = j


def _files(docs: DataFrame, a_path: str, b_path: str):
    """Both vocabulary files, read on the driver and broadcast (fixed sizes)."""
    out = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            out.append(f.read())
    return docs.sparkSession.sparkContext.broadcast(tuple(out))


def align(docs: DataFrame, a_path: str, b_path: str, kind: str = "end") -> DataFrame:
    """``docs`` and a struct column ``aligned``: a_ids, b_ids, the group of each of their tokens, and the
    links of ``kind`` (``end``, ``overlap`` or ``group``) as arrays of token numbers and weights.

    Texts that are NULL or empty, and texts whose bytes a tokenizer does not give back, have no
    tokens. A column ``aligned`` of the input is replaced; repeated rows each get theirs; an empty table
    gives an empty result. Paths are read on the driver.
    """
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    shared = _files(docs, a_path, b_path)
    names = ["a_ids", "b_ids", "a_group", "b_group", "a_at", "b_at", "weight"]

    @F.arrow_udf("struct<" + ",".join(f"{x}: array<int>" for x in names) + ">")
    def aligned(text: pa.Array) -> pa.Array:
        pair, rows = _pair(*shared.value), []
        for i, j in _blocks(text):
            for ids in pair.encode(text.slice(i, j - i).to_pylist()):
                one = Aligned(pair, [ids])
                rows.append(dict(zip(names, map(np.ndarray.tolist, (
                    one.a, one.b, one.groups("a"), one.groups("b"), *one.links(kind))))))
        return pa.array(rows, pa.struct([(x, pa.list_(pa.int32())) for x in names]))

    return docs.withColumn("aligned", aligned("text"))


def _counted(docs: DataFrame, shared) -> DataFrame:
    """One pass: per document doc_id, n_a, n_b, n_groups, groups_sha256, and its linked id pairs
    (packed a * 2**32 + b in order) with how often each is linked in it."""
    kinds = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"

    def run(batches):
        pair = _pair(*shared.value)
        for batch in batches:
            doc_id, text = batch.column(0), batch.column(1)
            for i, j in _blocks(text):
                block = Aligned(pair, pair.encode(text.slice(i, j - i).to_pylist()))
                n = j - i
                a_doc = np.repeat(np.arange(n), block.n_a)
                a, b, _ = block.links("end")
                doc, code = a_doc[a], block.a[a] << 32 | block.b[b]
                order = np.lexsort((code, doc))
                doc, code = doc[order], code[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
                first = np.flatnonzero(new)
                edges = np.searchsorted(doc[first], np.arange(n + 1)).astype(np.int32)
                # The last A token of each group is the one that ends at its cut.
                groups = np.bincount(a_doc[np.searchsorted(block.a_end, block.cuts)], minlength=n)
                yield pa.RecordBatch.from_arrays([
                    doc_id.slice(i, n), pa.array(block.n_a), pa.array(block.n_b), pa.array(groups.astype(np.int64)),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in block.group_texts(pair)], pa.string()),
                    pa.ListArray.from_arrays(edges, code[first]),
                    pa.ListArray.from_arrays(edges, np.diff(first, append=len(code)).astype(np.int32)),
                ], [x.split(" ")[0] for x in kinds.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, kinds)


def pair_counts(counted: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold each id pair, and whether no pair of its B id has more.

    Pairs are added up within each task's batches before they are shuffled, so a frequent pair does not
    meet in one task; there are no more pairs than the vocabularies have suffix pairs.
    """
    def add(batches):
        for batch in batches:
            pairs, times = batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()
            found, place = np.unique(pairs, return_inverse=True)
            n = np.bincount(place, weights=times, minlength=len(found)).astype(np.int64)  # exact below 2**53
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["pair", "n"])

    counts = materialize(counted.select("pairs", "times").mapInArrow(add, "pair long, n long")
                         .groupBy("pair").agg(F.sum("n").alias("n")), "alignment_counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    top = counts.groupBy(b).agg(F.max("n").alias("top"))
    return counts.withColumn("b", b).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def profile(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per document.

    Links are end links. A link counts as best if its id pair is, over the whole corpus, linked at least
    as often as any other pair of its B id; count_sum adds the corpus counts of the links. Texts without
    tokens (see ``align``) have zeros and ''. NULL ids stay NULL; repeated rows each get a row and each
    count; an empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    shared = _files(docs, a_path, b_path)
    counted = materialize(_counted(docs, shared), "alignment_documents")
    bound = suffix_pairs(_pair(*shared.value))
    table = materialize(pair_counts(counted), "alignment_pairs").limit(bound + 1).toPandas().sort_values("pair")
    if len(table) > bound:
        raise RuntimeError("more id pairs than the vocabularies allow")
    corpus = spark.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "n", "best")))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def look_up(batches):
        pair, n, best = corpus.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(batch)), pairs.value_lengths().to_numpy())
            at = np.searchsorted(pair, pairs.flatten().to_numpy())
            per_doc = [np.zeros(len(batch), np.int64) for _ in range(3)]
            for into, what in zip(per_doc, (times, times * best[at], times * n[at])):
                np.add.at(into, doc, what)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names[:4]], *map(pa.array, per_doc), batch.column("groups_sha256")], names)

    return counted.mapInArrow(look_up, ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in names))
