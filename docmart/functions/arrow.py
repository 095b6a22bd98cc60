"""The two text steps Spark has no built-in for, as Arrow UDFs.

* HTML entity decoding needs the full HTML5 entity table (named entities with
  and without ``;``, decimal and hex references).
* Accent folding needs Unicode NFKD decomposition and the combining-class test.

Both work on Arrow arrays: vectorised pyarrow kernels pick the values that need
Python (those holding ``&``; non-ASCII text) and handle everything else, so a
batch of plain rows never reaches per-row Python.
"""

from __future__ import annotations

import html
import sys
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship these helpers to executors by value: workers need only pyarrow and the standard library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])



def _char_class(test) -> str:
    """A regex class of the code points that pass, as ranges."""
    out, start = [], None
    for c in range(0x110001):
        hit = c < 0x110000 and not 0xD800 <= c < 0xE000 and test(chr(c))
        if hit and start is None:
            start = c
        elif not hit and start is not None:
            out.append(f"\\x{{{start:x}}}-\\x{{{c - 1:x}}}")
            start = None
    return "[" + "".join(out) + "]"


# Combining marks (those NFKD leaves behind), and str.isspace() characters.
_MARKS = _char_class(unicodedata.combining) + "+"
_SPACES = _char_class(str.isspace) + "+"


SLICE_ROWS, SLICE_BYTES = 512, 4 << 20
#: Characters of a text that travel where a NULL would do. Spark keeps the rows whose values are on the way in a queue, in the
#: end on disk, and only the bytes on the way, there and back, hold the next rows back: with NULLs a whole task queues up.
START = 1024


def in_slices(a: pa.Array, fn) -> pa.Array:
    """``fn`` of an array, a slice at a time, so that the Python objects and the intermediate arrays of few rows live at
    once, however many rows a batch has."""
    n = max(1, min(SLICE_ROWS, len(a) * SLICE_BYTES // max(a.nbytes, 1)))
    if len(a) <= n:
        return fn(a)
    return pa.concat_arrays([fn(a.slice(at, n)) for at in range(0, len(a), n)])


def unescape_one(x):
    if x is None:
        return None
    return html.unescape(x) if "&" in x else x


def fold_one(x):
    """Accent-free, lower-case text with whitespace runs collapsed; NULL -> ''."""
    if not x:
        return ""
    if not x.isascii():
        x = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return " ".join(x.split()).lower()


def _patch(values: pa.Array, mask: pa.Array, fn) -> pa.Array:
    """``values`` with the masked entries replaced by ``fn`` of each."""
    if not pc.any(mask).as_py():
        return values
    fixed = [fn(x) for x in pc.filter(values, mask).to_pylist()]
    return pc.replace_with_mask(values, mask, pa.array(fixed, type=values.type))


def unescape_values(a: pa.Array) -> pa.Array:
    return _patch(a, pc.fill_null(pc.match_substring(a, "&"), False), unescape_one)


def fold_values(a: pa.Array) -> pa.Array:
    """``fold_one`` of each value in vectorised kernels; only texts with a capital sigma, whose
    lower case depends on its place, go one by one."""
    a = pc.fill_null(a, "")
    bare = pc.replace_substring_regex(pc.utf8_normalize(a, form="NFKD"), _MARKS, "")
    fast = pc.utf8_lower(pc.utf8_trim(pc.replace_substring_regex(bare, _SPACES, " "), " "))
    return _patch_from(fast, a, pc.match_substring(bare, "Σ"), fold_one)


def _patch_from(out: pa.Array, src: pa.Array, mask: pa.Array, fn) -> pa.Array:
    """``out`` with masked entries replaced by ``fn`` of the matching ``src`` entries."""
    if not pc.any(mask).as_py():
        return out
    fixed = [fn(x) for x in pc.filter(src, mask).to_pylist()]
    return pc.replace_with_mask(out, mask, pa.array(fixed, type=out.type))


def _on_lists(a, fn):
    """Apply a values function to every element of a list array."""
    new_values = in_slices(a.values, fn)
    return type(a).from_arrays(a.offsets, new_values, mask=a.is_null())


@F.arrow_udf(T.StringType())
def html_unescape(a: pa.Array) -> pa.Array:
    return in_slices(a, unescape_values)


@F.arrow_udf(T.ArrayType(T.StringType()))
def html_unescape_array(a: pa.Array) -> pa.Array:
    return _on_lists(a, unescape_values)


@F.arrow_udf(T.StringType())
def fold(a: pa.Array) -> pa.Array:
    return in_slices(a, fold_values)


@F.arrow_udf(T.ArrayType(T.StringType()))
def fold_array(a: pa.Array) -> pa.Array:
    return _on_lists(a, fold_values)
