"""Options of a test bank out of problem XML documents."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.functions import text_hash

# The element names the walk knows.
TEXT_TAGS = ("p", "label", "h3")
RESPONSE_TAGS = ("multiplechoiceresponse", "choiceresponse", "optionresponse", "stringresponse", "numericalresponse")
TYPED_TAGS = ("stringresponse", "numericalresponse")
INNER_TEXT_TAGS = ("p", "label")
INPUT_TAGS = ("choicegroup", "checkboxgroup", "optioninput", "additional_answer", "formulaequationinput", "textline")
HINT_TAG = "compoundhint"

OPTION_FIELDS = ["choice_id", "choice_txt", "option_correct", "course", "problem", "question_id", "question_txt",
                 "input_type"]
_ROW = ("course STRING, problem STRING, question_id STRING, question_txt STRING, input_type STRING, choice_id STRING, "
        "choice_txt STRING, option_correct STRING, hashed BOOLEAN, reject STRING, tag STRING")
_COLUMNS = [part.split(" ")[0] for part in _ROW.split(", ")]
_LISTED = re.compile(r"""\s*(?:'((?:[^']|'')*)'|"([^"]*)"|([^,]+?))\s*(?:,|$)""")


def _inner_text(node: ET.Element) -> str:
    return " ".join(t.strip() for t in node.itertext())


def listed_options(text: str) -> list[str]:
    """Entries of an option list such as ('a','b')."""
    return [next(g for g in m.groups() if g is not None).replace("''", "'") for m in _LISTED.finditer(text[1:-1])]


def _options_of(response: ET.Element) -> tuple[list[tuple], str, str, list[tuple]]:
    """(options, input type, extra question text, rejects) of one response element."""
    options, rejects, kind, extra = [], [], "null", ""
    if response.tag in TYPED_TAGS:
        options.append(("", response.get("answer", ""), "", False))
    for node in response:
        if node.tag in INNER_TEXT_TAGS:
            extra += _inner_text(node)
            continue
        if node.tag not in INPUT_TAGS:
            continue
        if node.tag == "additional_answer":
            options.append(("", node.get("answer", ""), "", False))
        else:
            kind = node.tag
        if node.tag == "optioninput" and node.get("options") and node.get("correct") is not None:
            for entry in listed_options(node.get("options")):
                options.append((None, entry, str(entry == node.get("correct")).lower(), True))
        place = 0
        for choice in node:
            if choice.tag == HINT_TAG:
                continue
            shown = choice.text or "None"
            own = f"choice_{place}" if choice.tag == "choice" else None
            place += 1
            if choice.get("correct") is None:
                rejects.append(("no correct attribute", choice.tag))
            options.append((own, shown, choice.get("correct", ""), own is None))
    return options, kind, extra, rejects


def _walk(course: str, problem: str, xml: str) -> list[tuple]:
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return [(course, problem, *[None] * 7, "document not parsed", None)]
    rows, text, number = [], "", 1
    for node in root:
        if node.tag in TEXT_TAGS:
            shown = _inner_text(node)
            text += shown + "\n" if shown else ""
        elif node.tag in RESPONSE_TAGS:
            number += 1
            options, kind, extra, rejects = _options_of(node)
            head = (course, problem, f"{problem}_{number}_1", text + extra, kind)
            text = ""
            rows += [(*head, *option, None, None) for option in options]
            rows += [(*head, None, None, None, None, reason, tag) for reason, tag in rejects]
        else:
            # only direct children count; what lies deeper is reported
            rows += [(course, problem, *[None] * 7, "nested response not read", n.tag) for n in node.iter()
                     if n is not node and n.tag in RESPONSE_TAGS]
    return rows


def _walk_all(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r for c, p, x in zip(batch["course"], batch["problem"], batch["xml"]) for r in _walk(c, p, x)]
            yield pd.DataFrame(rows, columns=_COLUMNS)

    return docs.where(F.col("xml").isNotNull()).select("course", "problem", "xml").mapInPandas(run, _ROW)


def extract_test_bank(docs: DataFrame) -> DataFrame:
    """One row per option of every question. Running text of p, label and h3 is the text of the next question; questions
    are numbered from two; the id of an option without an own one is a hash of its text."""
    rows = _walk_all(docs).where(F.col("reject").isNull())
    own = F.when(F.col("hashed"), text_hash(F.col("choice_txt"))).otherwise(F.col("choice_id"))
    return rows.withColumn("choice_id", own).select(*OPTION_FIELDS)


def rejected_elements(docs: DataFrame) -> DataFrame:
    """What the walk could not use: options without a correct attribute, nested responses, broken documents."""
    return _walk_all(docs).where(F.col("reject").isNotNull()).select("course", "problem", "question_id", "reject", "tag")
