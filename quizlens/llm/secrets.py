"""Secret scan: fixed patterns, and strings in a sensitive context that a primed compressor finds new.

1. One pass over the texts finds the spans of the fixed kinds (`assign`, `access`, `hex`) and the candidates of the method: strings of
   letters and digits mixed, `CANDIDATE` characters or more, that begin within `REACH` characters after a sensitive word. A candidate is kept
   with its surroundings; only documents with findings leave more than counts.
2. The identifiers of these surroundings are counted over the whole corpus; the most frequent ones and a fixed list of code words are the
   compressor's dictionary, `DICTIONARY` bytes at most.
3. A candidate's novelty is the number of bytes by which the compressed surroundings grow when it is put in. What repeats a name of the
   surroundings or of the dictionary costs a few bytes; a random string costs most of its length. From `NOVEL` bytes per character on,
   a candidate is reported as kind `novel`, unless it lies within a span of a fixed kind.

Spans are code points, end exclusive, the whole match. Within one kind matches are leftmost and do not overlap; a match that is too short is
dropped after it is consumed.

Defined results: a null text is empty and has no findings; texts of any length are scanned whole. Repeated rows are scanned each for
itself. An empty table gives an empty result. Other columns are carried along; columns named as the output's are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.sinks.stage import stage

KINDS = ("assign", "access", "hex", "novel")
# fixed values: pattern, group whose length counts, least length
PATTERNS = (
    (re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(r"[0-9a-f]{24,}"), 0, 24),  # the same runs as with + and a least length of 24
)
# fixed values: words that make their neighbourhood sensitive
SENSITIVE = re.compile(r"(?ai:passphrase|password|passwd|secret|token|api[ _-]?key|credential|private[ _-]?key|authorization|bearer|access[ _-]?key)")
# fixed values: names common in code, always part of the dictionary
CODE_WORDS = ("access_key access_token api_key apikey auth authorization bearer bool class client config const credential def export false final "
              "float function getenv header host http https import int key let login null password passphrase port private_key public return secret "
              "self session static str string token true url user username val value var void")
CANDIDATE, REACH, AROUND, DICTIONARY, NOVEL = 16, 64, 200, 16384, 0.5
_RUN = re.compile(r"[A-Za-z0-9+/_=.~-]{%d,}" % CANDIDATE)
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

_SPAN = "STRUCT<kind: INT, start: INT, end: INT, value: INT>"
_FOUND = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.int32())])
_CANDIDATE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("before", pa.string()), ("text", pa.string()), ("after", pa.string())])


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the fixed kinds, in order."""
    out = []
    for kind, (pattern, group, least) in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), kind, m.end(), m.start(group)))
    return sorted(out)


def candidates(text: str, found: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Strings in a sensitive context that no span of a fixed kind covers; in time linear in the text."""
    out, seen = [], 0
    runs = _RUN.finditer(text)
    run = next(runs, None)
    starts = [s for s, *_ in found]
    reach = list(accumulate((e for _, _, e, _ in found), max))  # furthest end among the spans up to here
    for m in SENSITIVE.finditer(text):
        while run is not None:
            start = max(run.start(), m.end(), seen)
            if run.end() - start < CANDIDATE:  # behind the word, or too little of it left
                run = next(runs, None)
                continue
            if start > m.end() + REACH:
                break
            seen = run.end()
            v = text[start:seen]
            covered = bisect_right(starts, start)
            if _DIGIT.search(v) and _LETTER.search(v) and not (covered and reach[covered - 1] >= seen):
                out.append((start, seen))
            run = next(runs, None)
        if run is None:
            break
    return out


def compressor(words: str) -> zstandard.ZstdCompressor:
    """A compressor primed with the dictionary's text."""
    primed = zstandard.ZstdCompressionDict(words.encode()[-DICTIONARY:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    params = zstandard.ZstdCompressionParameters.from_level(9, write_content_size=False, write_checksum=False, write_dict_id=False)
    return zstandard.ZstdCompressor(dict_data=primed, compression_params=params)


def novelty(zstd: zstandard.ZstdCompressor, before: str, text: str, after: str) -> int:
    """Compressed bytes that the text adds to its surroundings."""
    around = (after + "\n" + before).encode()
    return len(zstd.compress(around + text.encode())) - len(zstd.compress(around))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without `text`, with spans: all findings as (kind, start, end, value, novelty), in order."""
    rest = [c for c in docs.columns if c not in (text, "spans")]
    given = docs.select(*[docs[c] for c in rest], docs[text].alias("__text"))
    kept = docs.select(*[docs[c] for c in rest])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, strings = [], []
            for t in b.column("__text").to_pylist():
                t = t or ""
                found = base_spans(t)
                spans.append([(k, s, e, v) for s, k, e, v in found])
                strings.append([(s, e, t[max(0, s - AROUND) : s], t[s:e], t[e : e + AROUND]) for s, e in candidates(t, found)])
            names = [f.name for f in _FOUND], [f.name for f in _CANDIDATE]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in rest), pa.array([[dict(zip(names[0], x, strict=True)) for x in r] for r in spans], pa.list_(_FOUND)),
                 pa.array([[dict(zip(names[1], x, strict=True)) for x in r] for r in strings], pa.list_(_CANDIDATE))], [*rest, "__found", "__strings"])

    found = stage(given.mapInArrow(find, f"{fields + ', ' if fields else ''}__found ARRAY<{_SPAN}>, __strings ARRAY<STRUCT<start: INT, end: INT, before: STRING, text: STRING, after: STRING>>"), "secrets")

    around = found.select(F.explode("__strings").alias("s")).select(F.explode(F.regexp_extract_all(F.concat_ws(" ", "s.before", "s.after"), F.lit(r"([A-Za-z_][A-Za-z0-9_]{3,40})"), F.lit(1))).alias("word"))
    # the most frequent names, as many as a dictionary of DICTIONARY bytes can hold: a bounded list
    top = around.groupBy("word").count().where("count > 1").orderBy(F.desc("count"), "word").limit(DICTIONARY // 5).collect()
    words = " ".join([r["word"] for r in reversed(top)] + [CODE_WORDS])  # the most useful stand at the end, nearest to the text

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = compressor(words)
        for b in batches:
            out = []
            for spans, strings in zip(b.column("__found").to_pylist(), b.column("__strings").to_pylist(), strict=True):
                rows = [s | {"novelty": None} for s in spans]
                for c in strings:
                    n = novelty(zstd, c["before"], c["text"], c["after"])
                    if n >= NOVEL * (c["end"] - c["start"]):
                        rows.append({"kind": 3, "start": c["start"], "end": c["end"], "value": c["start"], "novelty": n})
                out.append(sorted(rows, key=lambda r: (r["start"], r["kind"])))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(out, pa.list_(pa.struct([*_FOUND, ("novelty", pa.int32())])))], [*rest, "spans"])

    return found.mapInArrow(judge, f"{fields + ', ' if fields else ''}spans ARRAY<STRUCT<kind: INT, start: INT, end: INT, value: INT, novelty: INT>>")


def as_text(spans) -> "F.Column":
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", id: str = "doc_id", mark: str = "<secret>") -> DataFrame:
    """docs with each finding's value replaced by a mark in `text`; all rows and columns stay. Novel strings count as findings."""
    columns = docs.columns
    numbered = docs.withColumn("__copy", docs[text])
    scanned = scan(numbered.select(*[numbered[c] for c in columns if c != text], numbered["__copy"], numbered[text]), text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t, spans in zip(b.column("__copy").to_pylist(), b.column("spans").to_pylist(), strict=True):
                if not spans or t is None:
                    texts.append(t)
                    continue
                out, at = [], 0
                for s in sorted((s["value"], s["end"]) for s in spans):
                    if s[1] > at:
                        out += [t[at : s[0]] if s[0] >= at else "", mark if s[0] >= at else ""]
                        at = s[1]
                texts.append("".join([*out, t[at:]]))
            cols = {**{c: b.column(c) for c in columns if c != text}, text: pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([cols[c] for c in columns], columns)

    return scanned.mapInArrow(cut, docs.schema)
