"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding starts from single code points and works off an agenda (a heap) of adjacent symbol
pairs whose joined text is a piece: best score first, leftmost first among equals; each merge
puts its new neighbours on the agenda. What is left becomes ids; symbols outside the vocabulary
become byte pieces.

No merge crosses a place where the two code points around it stand next to each other in
no piece: a merged symbol is a piece, and the two would stand side by side in it. A text is cut at
every such place (one numpy lookup a character). Chunks are encoded on their own, and a bounded
table of chunks already seen, kept for the life of a Python worker, saves most of the work.

Every chunk new to a worker is checked against the sentencepiece library, all new chunks of 256
texts in one call, and so are the ids and the decoded text of every ``_WHOLE``-th whole text; a
difference raises. The model file is read on the driver and its bytes are broadcast (a vocabulary,
a fixed size).
"""

from __future__ import annotations

import hashlib
import heapq
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
_CACHED_LENGTH, _CACHE_SIZE = 64, 600_000
_WHOLE = 16  # of so many texts one is compared with the library as a whole
_LEFT = (1 << 40) - 1
_RESULT = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])


class Codec:
    """Encoder and decoder of one model; ids are packed as little-endian unsigned 32-bit integers."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != 2 or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a BPE model without user-defined or unused pieces is asked for")
        if (spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix
                or not spec.escape_whitespaces or not proto.trainer_spec.byte_fallback):
            raise ValueError("a model with identity normalisation, dummy prefix and byte fallback is asked for")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        normal = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        ranks = {x: i for i, x in enumerate(sorted(set(normal.values()), reverse=True))}
        self.rank = {x: ranks[score] << 48 | len(x) for x, score in normal.items()}
        pack = [i.to_bytes(4, "little") for i in range(len(proto.pieces))]
        self.packed = {p.piece: pack[i] for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        at = {p.piece: pack[i] for i, p in enumerate(proto.pieces)}
        self.byte = [at[f"<0x{b:02X}>"] for b in range(256)]
        self.begin, self.end = pack[self.library.bos_id()], pack[self.library.eos_id()]
        # What an id stands for in a decoded text, and which ids are bytes.
        self.surface = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else b"" if p.type == CONTROL else
            proto.trainer_spec.unk_surface.encode() if p.type == UNKNOWN else
            p.piece.replace(SPACE, " ").encode() for p in proto.pieces]
        self.is_byte = [p.type == BYTE for p in proto.pieces]
        self.is_control = [p.type == CONTROL for p in proto.pieces]
        self.spaced = [p.type == NORMAL and p.piece.startswith(SPACE) for p in proto.pieces]
        # Which two characters stand side by side in a piece, by their places in an alphabet (0: in none).
        pairs = {x[i:i + 2] for x in normal for i in range(len(x) - 1)}
        alphabet = sorted(set("".join(pairs)))
        self.place = np.zeros(sys.maxunicode + 1, np.int32)
        self.place[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.width = len(alphabet) + 1
        self.apart = np.ones(self.width * self.width, bool)
        self.apart[[self.place[ord(x)] * self.width + self.place[ord(y)] for x, y in pairs]] = False
        # A character that joins nothing, to send chunks without a leading space to the library.
        self.lead = next(c for c in map(chr, range(9, sys.maxunicode)) if not self.place[ord(c)] and c != " ")
        self.lead_ids = len(self.library.encode(self.lead))
        self.seen: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        """``text`` behind the dummy prefix, spaces as ``SPACE``, cut wherever no piece joins two characters."""
        text = SPACE + text.replace(" ", SPACE)
        at = self.place[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        cuts = (np.flatnonzero(self.apart[at[:-1] * self.width + at[1:]]) + 1).tolist()
        return [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)])]

    def agenda(self, chunk: str) -> bytes:
        """Packed ids of one chunk."""
        # An agenda entry is one integer: rank of the score, left position, length of the piece.
        sym = list(chunk)
        rank, n = self.rank.get, len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r | i << 8 for i, r in enumerate(map(rank, map(str.__add__, sym, sym[1:]))) if r is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry >> 8 & _LEFT
            left, j = sym[i], after[i]
            if not left or j == n or len(left) + len(sym[j]) != entry & 255:
                continue  # one of the two has been merged since
            sym[i] = pair = left + sym[j]
            sym[j] = ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                r = rank(pair + sym[k])
                if r is not None:
                    heapq.heappush(heap, r | i << 8)
            h = before[i]
            if h >= 0:
                r = rank(sym[h] + pair)
                if r is not None:
                    heapq.heappush(heap, r | h << 8)
        packed, byte = self.packed, self.byte
        return b"".join([packed.get(s) or b"".join([byte[x] for x in s.encode()]) for s in sym if s])

    def _check(self, new: dict[str, bytes]) -> None:
        """Compare new chunks with the library, in one call.

        The library puts a space before every text, so a leading space is left out. A chunk that
        begins with none is sent behind ``lead``, which joins nothing, and the ids of that are taken off.
        """
        kept = [c for c in new if c != SPACE]  # alone it is the prefix of an empty text, which has no ids
        sent = [c[1:] if c[0] == SPACE else self.lead + c for c in kept]
        for chunk, ids in zip(kept, self.library.encode(sent, num_threads=1)):
            if array("I", ids[0 if chunk[0] == SPACE else self.lead_ids:]).tobytes() != new[chunk]:
                raise RuntimeError(f"the agenda differs from sentencepiece on {chunk!r}")

    def check_whole(self, texts: list[str | None], ids: list[bytes], decoded: list[str]) -> None:
        """Compare the ids and the decoded text of whole texts with the library."""
        found = self.library.encode([t or "" for t in texts], num_threads=1, add_bos=True, add_eos=True)
        for text, mine, back, its, its_text in zip(texts, ids, decoded, found, self.library.decode(found)):
            if array("I", its).tobytes() != mine or its_text != back:
                raise RuntimeError(f"ids or decoded text differ from sentencepiece on {(text or '')[:200]!r}")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text with begin and end ids; NULL counts as empty."""
        seen = self.seen
        if len(seen) > _CACHE_SIZE:
            seen.clear()
        pieces = [self.chunks(t) if t else [] for t in texts]
        new = {c: self.agenda(c) for c in set().union(*pieces).difference(seen)}
        self._check(new)
        seen.update(new)
        out = [b"".join([self.begin, *map(seen.__getitem__, chunks), self.end]) for chunks in pieces]
        for c in new:
            if len(c) > _CACHED_LENGTH:
                del seen[c]
        return out

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become U+FFFD one by one, as in the library."""
        numbers = memoryview(ids).cast("I")
        surface = self.surface
        raw = b"".join([surface[i] for i in numbers])
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = self._decode_slowly(numbers)
        first = next((i for i in numbers if not self.is_control[i]), None)
        return text[1:] if first is not None and self.spaced[first] else text  # the dummy prefix

    def _decode_slowly(self, numbers) -> str:
        out, run = [], b""

        def flush(run: bytes) -> str:
            text, i = "", 0
            while i < len(run):
                for k in (1, 2, 3, 4):
                    try:
                        text += run[i:i + k].decode()
                        i += k
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    text, i = text + "�", i + 1
            return text

        for i in numbers:
            if self.is_byte[i]:
                run += self.surface[i]
            else:
                out += [flush(run), self.surface[i].decode()]
                run = b""
        return "".join(out) + flush(run)


def _codec(model: bytes) -> Codec:
    """The codec of a model, one for the life of a worker (this module is sent by value with
    each task, so the codecs are held by a module of their own)."""
    held = sys.modules.setdefault("docmart_codecs", types.ModuleType("docmart_codecs")).__dict__
    key = hashlib.sha256(model).hexdigest()
    if key not in held:
        held[key] = Codec(model)
    return held[key]


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` and a struct column ``pieces``: ids (packed) and the text decoded from them.

    NULL texts count as empty (begin and end ids only). Any number of rows, repeated rows
    included; an empty table gives an empty result. A column ``pieces`` of the input is replaced.
    ``model_path`` is read on the driver.
    """
    with open(model_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    @F.arrow_udf(_RESULT)
    def pieces(text: pa.Array) -> pa.Array:
        codec = _codec(shared.value)
        ids, decoded = [], []
        for i in range(0, len(text), 256):
            texts = text.slice(i, 256).to_pylist()
            some = codec.encode(texts)
            back = [codec.decode(x) for x in some]
            codec.check_whole(texts[::_WHOLE], some[::_WHOLE], back[::_WHOLE])
            ids += some
            decoded += back
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                                          ["ids", "decoded"])

    return docs.withColumn("pieces", pieces("text"))


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row per document."""
    return encode_decode(docs.select("doc_id", "text"), model_path).select(
        "doc_id",
        F.expr("octet_length(pieces.ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("pieces.ids", 256).alias("ids_sha256"),
        F.sha2("pieces.decoded", 256).alias("decoded_sha256"))
