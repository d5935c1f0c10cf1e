"""Fill-in-middle transformation of texts with pyarrow.compute (operator 12).

A text is cut into units (lines with their line feed).  A digest of the seed and
``doc_id`` draws two cuts between units and the form; the units before, between
and after the cuts are prefix, middle and suffix, written out in the order of
the form with a sentinel before each:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``: the text as it is, where it is empty, holds a sentinel already (it
  could not be taken apart again) or the draw leaves it out

The draws are SQL expressions.  The cutting runs per Arrow batch in
pyarrow.compute without a loop over rows: the pieces between line feeds as one
list array, flattened with the index of their row, numbered, filtered by role,
put back into lists and joined.  There is no shuffle and a row stays whole, so a
task holds a batch of texts and its output.

Rows: a null text is empty and gives form plain, zero units and an empty output.
A null ``doc_id`` draws as the empty decimal.  Repeated ids draw alike, repeated
rows give repeated rows.  A very long text is a batch of its own as Spark cuts
them; one of a single line has one unit.  An empty table gives an empty result.
``transform`` keeps all columns beside its own, which it adds as one struct
``fim``; a column of that name is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 7
#: of 100 texts, how many are transformed, and how many of these get the form spm
RATE = 100
SPM_RATE = 50
# The sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
FIM = "n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """h1 to h4: the first four groups of eight digits of the SHA-256 of seed and id, as longs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _join(parts, *rest) -> pa.Array:
    return pc.binary_join_element_wise(parts, *rest, "")


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Values, row of each, number of each within its row, and values per row."""
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    row = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    begin = np.concatenate(([0], np.cumsum(size)))
    return pc.list_flatten(lists), row, np.arange(len(row)) - begin[row], size


def units(text: pa.Array) -> pa.ListArray:
    """Lines of each text, each with its line feed if it has one; an empty text has none."""
    piece, row, number, size = _flat(pc.split_pattern(text, "\n"))
    last = number == size[row] - 1
    line = _join(piece, pc.if_else(pa.array(last), "", "\n"))
    keep = ~(last & (pc.binary_length(piece).to_numpy() == 0))      # nothing after the last line feed
    return _lists(line.filter(pa.array(keep)), row[keep], len(text))


def _lists(values: pa.Array, row: np.ndarray, n: int) -> pa.ListArray:
    """Lists of the values of each of ``n`` rows; ``row`` ascends."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))), pa.int32()), values)


def pieces(text: pa.Array, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Units of each text, and its prefix, middle and suffix by the cuts drawn."""
    unit, row, number, size = _flat(units(text))
    a, b = h1 % (size + 1), h2 % (size + 1)
    role = (number >= np.minimum(a, b)[row]).astype(np.int8) + (number >= np.maximum(a, b)[row])
    return size, [pc.binary_join(_lists(unit.filter(pa.array(role == k)), row[role == k], len(text)), "") for k in range(3)]


def arrange(text: pa.Array, h: list[np.ndarray], rate: int = RATE, spm_rate: int = SPM_RATE) -> dict[str, pa.Array]:
    """Form, counts and output of each text of a batch."""
    size, (prefix, middle, suffix) = pieces(text, h[0], h[1])
    held = [pc.match_substring(text, s).to_numpy(zero_copy_only=False) for s in SENTINELS]
    whole = (size == 0) | np.logical_or.reduce(held) | (h[2] % 100 >= rate)
    spm = ~whole & (h[3] % 100 < spm_rate)
    p, s, m = SENTINELS
    chars = lambda x: pc.if_else(pa.array(whole), pa.scalar(None, pa.int64()), pc.utf8_length(x).cast(pa.int64()))
    output = pc.if_else(pa.array(whole), text, pc.if_else(pa.array(spm), _join(s, suffix, p, prefix, m, middle), _join(p, prefix, s, suffix, m, middle)))
    return {"n": pa.array(size, pa.int64()), "form": pc.if_else(pa.array(whole), "plain", pc.if_else(pa.array(spm), "spm", "psm")),
            "prefix_chars": chars(prefix), "middle_chars": chars(middle), "output": output}


def rebuild(output: pa.Array, form: pa.Array) -> pa.Array:
    """The text that an output of this form was made of."""
    p, s, m = SENTINELS
    plain = pc.equal(form, "plain")
    spm = pc.equal(form, "spm")
    # <first> one <second> two <M> middle; a text with sentinels of its own is plain, so each stands once
    body = pc.if_else(plain, _join(pa.array([p + s + m] * len(output))), output)
    body = pc.replace_substring(pc.replace_substring(body, p, m), s, m)
    part = lambda k: pc.list_element(pc.split_pattern(body, m), k)
    prefix, suffix = pc.if_else(spm, part(2), part(1)), pc.if_else(spm, part(1), part(2))
    return pc.if_else(plain, output, _join(prefix, part(3), suffix))


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with the struct ``fim``: n units, form, prefix_chars, middle_chars, output."""
    def run(batches):
        for b in batches:
            t = b.column("_text")
            h = [b.column(f"_h{k}").to_numpy(zero_copy_only=False) for k in range(4)]
            made = arrange(t, h, rate, spm_rate)
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.StructArray.from_arrays(list(made.values()), names=list(made))], names=["_row", "fim"])

    own = [c for c in docs.columns if c != "fim"]
    # the text travels once, as the transformed column; the others as they are
    row = F.struct(*[F.col(f"`{c}`") for c in own if c != text])
    rows = docs.select(row.alias("_row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"),
                       *(h.alias(f"_h{k}") for k, h in enumerate(draws(F.col(key), seed))))
    schema = T.StructType([rows.schema["_row"], T.StructField("fim", T.StructType.fromDDL(FIM))])
    return rows.mapInArrow(run, schema).select("_row.*", "fim")


def restored(transformed: DataFrame) -> DataFrame:
    """``transformed`` with ``restored``: each text, rebuilt from output and form alone."""
    def run(batches):
        for b in batches:
            fim = b.column("fim")
            yield pa.RecordBatch.from_arrays([*b.columns, rebuild(pc.struct_field(fim, "output"), pc.struct_field(fim, "form"))],
                                             names=[*b.schema.names, "restored"])
    rows = transformed.drop("restored")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("restored", T.StringType())]))
