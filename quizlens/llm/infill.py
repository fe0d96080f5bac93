"""Fill-in-middle transformation with a piece table.

A document is a list of descriptors (buffer, start, end) over two buffers that never change: its text and the sentinels. It begins as
one descriptor; cutting splits descriptors, an arrangement permutes the three parts and puts each part's sentinel before it. No text is copied until
an output is written; hashes run over the descriptors. `restore` reads an arranged text back: its sentinels give descriptors over the
output, the inverse permutation puts them in order again.

The cuts and the form follow from `seed` and the document's id alone: h1 to h4 are the first four 8-digit groups of the hex SHA-256 of
`seed:id`. The prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) of the n code points, the middle after the larger. A text that is
empty or contains a sentinel stays `plain`, as do all with h3 % 100 >= `rate`; of the others those with h4 % 100 < `spm_rate` are `spm`, the rest `psm`.
Every row is worked on alone: no shuffle, and a task holds one document's output at a time.

Defined results: a null text is empty and plain, a null id counts as the empty string. A text of any length is cut as a whole. Repeated rows get equal
results. An empty table gives an empty result. Other columns are carried along; columns named as the output's are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEXT, MARKS = 0, 1
# fixed values: the sentinel before each part, in the text's order (prefix, middle, suffix)
SENTINELS = ("<P>", "<M>", "<S>")
BUFFER = "".join(SENTINELS)
_ENDS = tuple(accumulate(map(len, SENTINELS)))
MARK = tuple((MARKS, end - len(s), end) for s, end in zip(SENTINELS, _ENDS, strict=True))
# fixed values: the parts in the order of each form's output
ORDER = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
PLAIN = "plain"
HASHED_AT_ONCE = 1 << 20

Piece = tuple[int, int, int]


def cut(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The descriptors before and after unit `at`; the one that holds it is split."""
    before, after, passed = [], [], 0
    for buffer, start, end in pieces:
        here = min(max(at - passed, 0), end - start)
        if here:
            before.append((buffer, start, start + here))
        if here < end - start:
            after.append((buffer, start + here, end))
        passed += end - start
    return before, after


def draws(key: str) -> tuple[int, int, int, int]:
    """h1 to h4 of a key."""
    digest = hashlib.sha256(key.encode()).hexdigest()
    return tuple(int(digest[8 * k : 8 * k + 8], 16) for k in range(4))


def form_of(text: str, h3: int, h4: int, rate: int, spm_rate: int) -> str:
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= rate:
        return PLAIN
    return "spm" if h4 % 100 < spm_rate else "psm"


def arranged(text: str, key: str, rate: int, spm_rate: int) -> tuple[str, list[Piece], tuple[int, int] | None]:
    """Form, descriptors of the output, and where prefix and middle end (None for plain)."""
    h1, h2, h3, h4 = draws(key)
    n = len(text)
    whole = [(TEXT, 0, n)] if n else []
    form = form_of(text, h3, h4, rate, spm_rate)
    if form == PLAIN:
        return form, whole, None
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    rest, suffix = cut(whole, high)
    prefix, middle = cut(rest, low)
    parts = (prefix, middle, suffix)
    return form, [piece for k in ORDER[form] for piece in (MARK[k], *parts[k])], (low, high)


def parted(output: str, form: str) -> list[Piece]:
    """Descriptors over an output that give the text back: found by its sentinels, put in order by the inverse permutation."""
    if form == PLAIN:
        return [(TEXT, 0, len(output))]
    order = ORDER[form]
    starts, at = [], 0
    for k in order:
        at = output.index(SENTINELS[k], at)
        starts.append(at)
        at += len(SENTINELS[k])
    found = [(TEXT, start + len(SENTINELS[k]), end) for k, start, end in zip(order, starts, [*starts[1:], len(output)], strict=True)]
    return [found[order.index(part)] for part in range(len(order))]


def written(pieces: list[Piece], text: str) -> str:
    buffers = (text, BUFFER)
    return "".join(buffers[b][s:e] for b, s, e in pieces)


def hashed(pieces: list[Piece], text: str) -> str:
    """SHA-256 of what the descriptors spell, in UTF-8, streamed."""
    buffers, out = (text, BUFFER), hashlib.sha256()
    for b, start, end in pieces:
        for at in range(start, end, HASHED_AT_ONCE):
            out.update(buffers[b][at : min(end, at + HASHED_AT_ONCE)].encode())
    return out.hexdigest()


_ADDED = (("n", pa.int64(), "BIGINT"), ("form", pa.string(), "STRING"), ("prefix_chars", pa.int64(), "BIGINT"), ("middle_chars", pa.int64(), "BIGINT"))
_PIECES = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
_PIECES_SQL = "ARRAY<STRUCT<buffer: INT, start: BIGINT, end: BIGINT>>"


def _run(docs: DataFrame, text: str, id: str, settings: tuple[str, int, int], more: list[tuple[str, pa.DataType, str]], make) -> DataFrame:
    """docs without `text`, with the form's columns and those that make(text, form, pieces) returns in the order of `more`."""
    added = [*_ADDED, *more]
    names = {name for name, _, _ in added}
    rest = [c for c in docs.columns if c != text and c not in names]
    seed, rate, spm_rate = settings
    given = docs.select(*[docs[c] for c in rest], docs[text].alias("__text"), F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id].cast("string"), F.lit(""))).alias("__key"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[docs[c] for c in rest]).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[] for _ in added]
            for t, key in zip(b.column("__text"), b.column("__key").to_pylist(), strict=True):
                t = t.as_py() or ""  # one text at a time
                form, pieces, ends = arranged(t, key, rate, spm_rate)
                low, high = ends or (None, None)
                for column, value in zip(out, (len(t), form, low, None if ends is None else high - low, *make(t, form, pieces)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), *(pa.array(v, kind) for v, (_, kind, _) in zip(out, added, strict=True))], [*rest, *(n for n, _, _ in added)])

    return given.mapInArrow(run, ", ".join([*fields, *(f"{name} {kind}" for name, _, kind in added)]))


def transform(docs: DataFrame, text: str = "text", id: str = "doc_id", seed: str = "1", rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """docs without `text`, with n, form, prefix_chars, middle_chars, pieces (the output's descriptors, in code points) and output (its text)."""
    def make(t, form, pieces):
        return [{"buffer": b, "start": s, "end": e} for b, s, e in pieces], written(pieces, t)

    return _run(docs, text, id, (seed, rate, spm_rate), [("pieces", _PIECES, _PIECES_SQL), ("output", pa.string(), "STRING")], make)


def restore(arranged_docs: DataFrame, output: str = "output", form: str = "form", text: str = "text") -> DataFrame:
    """arranged_docs with `text` in place of `output`: the documents' texts, from output and form alone. A null output or form gives a null text."""
    columns = [c for c in arranged_docs.columns if c not in (output, text)]
    given = arranged_docs.select(*[arranged_docs[c] for c in columns], arranged_docs[output].alias("__output"), arranged_docs[form].alias("__form"))
    schema = arranged_docs.select(*[arranged_docs[c] for c in columns], arranged_docs[output].cast("string").alias(text)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if o is None or f is None else written(parted(o, f), o) for o, f in zip(b.column("__output").to_pylist(), b.column("__form").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(texts, pa.string())], [*columns, text])

    return given.mapInArrow(run, schema)


def digests(docs: DataFrame, text: str = "text", id: str = "doc_id", seed: str = "1", rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """As `transform`, with the hashes of the output and of the text restored from it in place of both: no text leaves the task."""
    def make(t, form, pieces):
        output = written(pieces, t)
        return hashed(pieces, t), hashed(parted(output, form), output)

    return _run(docs, text, id, (seed, rate, spm_rate), [("output_sha256", pa.string(), "STRING"), ("restored_sha256", pa.string(), "STRING")], make)
