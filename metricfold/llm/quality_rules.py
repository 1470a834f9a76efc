"""Rule bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements beside one
``fail_bits`` integer (bit ``r`` set: rule ``r`` failed).  A policy is a named, versioned set
of rules, that is a mask: a document passes when ``fail_bits & mask = 0``.  New policies and
ablations therefore read the ledger, never the texts again.

Words are ``[^\\x20\\x09-\\x0D]+``.  A null or empty text has no words and fails ``few_words``.
Ties and repeated rows need no rule (each row is judged alone); a null id stays null.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_upper_words", "n_distinct_words")
SCHEMA = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)

# Each rule: the condition under which a document FAILS, over the measurements in integers
# (thresholds as per cent), so that every engine agrees on it.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "duplicate_lines": "n_dup_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines",
    "upper_case": "100 * n_upper_words > 30 * n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "few_distinct": "n_words >= 50 AND 100 * n_distinct_words < 5 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}

# Policy versions: never edited once published; a change is a new version.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_windows"),
    "web-1": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "upper_case"),
    "web-2": tuple(RULES),
}
CURRENT = "web-2"

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    text = text or ""
    words = _WORDS.findall(text)
    lines = [line for line in text.split("\n") if _WORDS.search(line)]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) < len(windows):
        covered_to = 0
        for i, w in enumerate(windows):
            if counts[w] > 1:
                repeated += i + 3 - max(i, covered_to)
                covered_to = i + 3
    return (len(words), sum(map(len, words)), sum(map(text.count, _SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), repeated,
            sum(1 for w in words if len(w) > 1 and w.isupper()), len(set(words)))


def _measure_batches(batches):
    for batch in batches:
        rows = [measure(t.as_py()) for t in batch.column(1)]
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *MEASURES])


def fail_bits(rules: dict[str, str] = RULES) -> Column:
    bits = F.lit(0).cast("long")
    for i, condition in enumerate(rules.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << i)).otherwise(0).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``fail_bits`` of every document: one pass, no shuffle."""
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(_measure_batches, SCHEMA).withColumn("fail_bits", fail_bits())


def mask_of(policy: str) -> int:
    return sum(BIT[rule] for rule in POLICIES[policy])


def passes(policy: str) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy)).cast("long")) == 0


def ablations(ledgered: DataFrame, policy: str = CURRENT) -> DataFrame:
    """What each rule of a policy does: documents failing it, failing it alone, and the number
    kept if it were dropped.  The ledger is first reduced to a histogram of ``fail_bits``
    (at most 2^rules rows, combined map-side), and all counts come from its bits."""
    mask = F.lit(mask_of(policy)).cast("long")
    histogram = (ledgered.withColumn("bits", F.col("fail_bits").bitwiseAND(mask))
                 .groupBy("bits").agg(F.count(F.lit(1)).alias("docs")))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                      for r in POLICIES[policy]])
    each = histogram.select("bits", "docs", F.explode(rules).alias("r")).select("bits", "docs", "r.*")
    failed = F.col("bits").bitwiseAND(F.col("bit")) != 0
    without = F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0
    total = lambda condition: F.sum(F.when(condition, F.col("docs")).otherwise(0))
    return each.groupBy("rule").agg(
        F.lit(policy).alias("policy"), total(failed).alias("failed"),
        total(F.col("bits") == F.col("bit")).alias("failed_alone"),
        total(F.col("bits") == 0).alias("kept"), total(without).alias("kept_without"))


def judged(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` (policy ``base-1``) and ``kept`` (the given policy)."""
    return ledger(docs).select(
        "doc_id", *MEASURES, "fail_bits", (~passes("base-1")).alias("base_failed"),
        (passes("base-1") & passes(policy)).alias("kept"))
