"""Quality rules, line first.

Every line with a word is judged by itself; lines that fail are removed, and a document that
loses too much of its text with them is rejected. A second, document-wide set of base rules
(length and repeated word runs) rejects whatever the lines say.

Line rules, each on the words ``[^\\x20\\x09-\\x0D]+`` of the line:

* navigation: at least three menu separators, and one to every four words;
* punctuation: five words or more without any sentence mark, or more than one exclamation mark
  to every two words, or more than one markup character ``#*$%&|<>`` to every two words;
* boilerplate: a stock phrase of web pages.

Defined results: a null text counts as empty; a document without words fails the base rules;
repeated rows are judged one by one; further columns are passed through by ``clean`` and
``judge`` unless their name is one of the result columns, which then win.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.llm.words import Words, as_bytes, resting, slices

# The phrases of the boilerplate rule.
BOILERPLATE = [
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy",
    "accept cookies", "enable javascript", "click here", "sign up for our newsletter", "subscribe to our newsletter",
    "skip to content", "share on facebook",
]
SEPARATORS = "|»›•"
SENTENCE_MARKS = ".!?…。！？"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_LOSS_PERCENT = 50
WINDOW = 8

FIELDS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
          ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("n_failed_lines", pa.int64()),
          ("failed_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]
SPARK_FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                "n_failed_lines long, failed_words long, base_failed boolean, kept boolean")

_PHRASES = re.compile("|".join(map(re.escape, BOILERPLATE)), re.I | re.A)
_SEPARATOR = re.compile(f"[{re.escape(SEPARATORS)}]")
_MARK = re.compile(f"[{re.escape(SENTENCE_MARKS)}]")
_MARKUP = re.compile(f"[{re.escape(SYMBOLS)}]")
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_SPACES = " \t\n\v\f\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def line_fails(line: str, n_words: int) -> bool:
    """Whether a line of n_words words fails one of the three rules."""
    separators = len(_SEPARATOR.findall(line))
    if separators >= 3 and 4 * separators >= n_words:
        return True
    if n_words >= 5 and (not _MARK.search(line) or 2 * line.count("!") > n_words
                         or 2 * len(_MARKUP.findall(line)) > n_words):
        return True
    return _PHRASES.search(line) is not None


def _lines(text: str | None) -> tuple[int, int, int, str]:
    """(repeated lines, failed lines, words in them, text without them)."""
    if not text:
        return 0, 0, 0, ""
    seen, kept, repeated, failed, lost = set(), [], 0, 0, 0
    for line in text.split("\n"):
        if not line.strip(_SPACES):
            kept.append(line)
            continue
        repeated += line in seen
        seen.add(line)
        n = len(_WORD.findall(line))
        if line_fails(line, n):
            failed, lost = failed + 1, lost + n
        else:
            kept.append(line)
    return repeated, failed, lost, "\n".join(kept)


def _repeated_words(words: Words) -> np.ndarray:
    """Per text, the words inside WINDOW-word runs that the text holds more than once."""
    at, h = words.windows(WINDOW)
    bounds = np.searchsorted(words.of[at], np.arange(len(words.first)))
    out = np.zeros(len(words.first) - 1, np.int64)
    for i in range(len(out)):
        own = h[bounds[i]:bounds[i + 1]]
        ordered = np.sort(own)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            hit = np.isin(own, twice).astype(np.int64)
            edge = np.zeros(len(own) + WINDOW, np.int64)
            edge[:len(own)] += hit
            edge[WINDOW:] -= hit
            out[i] = np.count_nonzero(np.cumsum(edge))
    return out


def measure(texts: list[str | None]) -> tuple[list[np.ndarray], list[str]]:
    """The result columns in the order of FIELDS, and the cleaned texts."""
    columns, cleaned = [[] for _ in FIELDS], []
    raw = [as_bytes(t) for t in texts]
    for part in slices([len(b) for b in raw]):
        words = Words(raw[part])
        n_words = words.counts()
        total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[words.text_starts])
        chars = total(words._inside & ((words.bytes & 0xC0) != 0x80))
        symbols = total(_IS_SYMBOL[words.bytes])
        repeats = _repeated_words(words)
        lines = [_lines(t) for t in texts[part]]
        dup, failed, lost = (np.array([x[k] for x in lines], np.int64) for k in range(3))
        base = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
        kept = ~base & (100 * lost <= MAX_LOSS_PERCENT * n_words)
        for column, values in zip(columns, (n_words, chars, symbols, dup, repeats, failed, lost, base, kept), strict=True):
            column.append(values)
        cleaned += [x[3] for x in lines]
    return [np.concatenate(c) if c else np.zeros(0) for c in columns], cleaned


def judge(docs: DataFrame, text: str = "text", with_text: bool = False) -> DataFrame:
    """``docs`` without its text, plus the measurements, ``base_failed`` and ``kept``.

    ``with_text`` keeps the column, holding the text without its failed lines. No shuffle.
    """
    names = [name for name, _ in FIELDS]
    rest = [c for c in docs.columns if c not in (text, *names)]
    rows = docs.select(F.col(text).cast("string").alias(text), *[F.col(f"`{c}`") for c in rest])

    @resting
    def run(batches):
        for batch in batches:
            # a few megabytes at a time: a batch of Spark's holds as many rows as it may, of any length
            for part in slices(pc.binary_length(batch.column(0)).fill_null(0).to_pylist()):
                piece = batch.slice(part.start, part.stop - part.start)
                columns, cleaned = measure(piece.column(0).to_pylist())
                arrays = [pa.array(v).cast(t) for v, (_, t) in zip(columns, FIELDS, strict=True)]
                own = [pa.array(cleaned, pa.string())] if with_text else []
                yield pa.RecordBatch.from_arrays([*own, *piece.columns[1:], *arrays], names=[*[text] * with_text, *rest, *names])

    fields = rows.schema.fields if with_text else rows.schema.fields[1:]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), SPARK_FIELDS])
    return rows.mapInArrow(run, schema)


def clean(docs: DataFrame) -> DataFrame:
    """The kept documents without their failed lines, in the columns of ``docs``."""
    judged = judge(docs, with_text=True).filter("kept")
    if "n_chars" in docs.columns:
        judged = judged.withColumn("n_chars", F.length("text").cast("long"))
    return judged.select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs)
