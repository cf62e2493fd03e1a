"""Quality rules as a bitmask ledger (DataFrame functions only).

``rule_ledger`` measures every text once and sets one bit per failed rule.  A policy is a
set of rules under a version name, that is, a mask; applying another policy, or asking
what each rule alone is worth, needs the ledger only and never the texts again.

Null and empty texts have no words: all measurements are 0 and only ``few_words`` fails.
Repeated rows are judged alike, each on its own; further columns are kept unless they
bear the name of a ledger column, which then holds the ledger's value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runlens.llm.registry import query
from runlens.llm.shared import load

SPACE = r"[ \t\n\x0B\f\r]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def rules() -> dict[str, Column]:
    """Every rule as the condition of failing it; a rule's place is its bit."""
    n_words, lines = F.col("n_words"), F.col("n_lines")
    return {
        "few_words": n_words < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * n_words,
        "symbols": 10 * F.col("n_symbols") > 3 * n_words,
        "duplicate_lines": 100 * F.col("n_dup_lines") > 50 * lines,
        "short_words": F.col("word_chars") < 2 * n_words,
        "long_words": F.col("word_chars") > 15 * n_words,
    }


#: Rules of each version.  A later version adds to the base.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v2": (
        "few_words",
        "repeated_words",
        "symbols",
        "duplicate_lines",
        "short_words",
        "long_words",
    ),
}
CURRENT = "v2"


def mask_of(names: tuple[str, ...]) -> int:
    order = list(rules())
    return sum(1 << order.index(n) for n in names)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements; no shuffle, each text is cut into words once.

    Windows are compared by a 64-bit hash of their words.  Places are sorted only in the
    texts that have some window twice.
    """
    clash = [c for c in df.columns if c.startswith("_m_") or c in MEASURES]
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    cut = df.drop(*(c for c in clash if c != text)).select(
        "*",
        F.array_remove(F.split(body, SPACE + "+"), "").alias("_m_words"),
        F.filter(
            F.split(body, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^ \t\n\x0B\f\r]"))
        ).alias("_m_lines"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    places = F.sequence(F.lit(0), F.size("_m_words") - WINDOW)
    one = F.transform(
        places,
        lambda i: F.xxhash64(*(F.get(F.col("_m_words"), i + k) for k in range(WINDOW))),
    )
    hashed = cut.select(
        "*",
        F.when(F.size("_m_words") >= WINDOW, one)
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_m_hashes"),
    )
    distinct = F.size(F.array_distinct("_m_hashes"))
    sorted_ = hashed.select(
        "*",
        F.when(
            distinct < F.size("_m_hashes"),
            F.sort_array(
                F.transform("_m_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            ),
        ).alias("_m_sorted"),
    )
    near = lambda i: F.get(F.col("_m_sorted"), i)["h"]
    twice = F.filter(
        F.col("_m_sorted"),
        lambda z, k: (z["h"].eqNullSafe(near(k - 1))) | (z["h"].eqNullSafe(near(k + 1))),
    )
    starts = sorted_.select("*", F.sort_array(twice["i"]).alias("_m_starts"))
    covered = F.aggregate(
        "_m_starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
        lambda a, x: F.struct(
            x.alias("last"), (a["total"] + F.least(F.lit(WINDOW), x - a["last"])).alias("total")
        ),
    )["total"]
    lines = F.size("_m_lines").cast("long")
    return starts.select(
        *(F.col(f"`{c}`") for c in df.columns if c not in clash or c == text),
        F.size("_m_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_m_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        lines.alias("n_lines"),
        (lines - F.size(F.array_distinct("_m_lines"))).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def rule_ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """Measurements of every row and ``failed_mask``, one bit per failed rule.

    Rows leave through an array that is unpacked again: a filter on the ledger would
    otherwise be moved below the measurements, computing each many times over.
    """
    kept = df.drop("failed_mask") if text != "failed_mask" else df
    mask = F.lit(0)
    for bit, failed in enumerate(rules().values()):
        mask = mask.bitwiseOR(F.when(failed, F.lit(1 << bit)).otherwise(F.lit(0)))
    ledger = measure(kept, text).withColumn("failed_mask", mask.cast("long"))
    return ledger.select(F.explode(F.array(F.struct("*"))).alias("_m_row")).select("_m_row.*")


def fails(policy: str) -> Column:
    """Whether a ledger row fails some rule of the policy."""
    return F.col("failed_mask").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) != 0


def apply_policy(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    return ledger.withColumn("kept", ~fails(policy))


def passing(df: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows that pass every rule of the policy, columns as they are."""
    rows = df.select(F.struct("*").alias("_row"), F.col(f"`{text}`"))
    return apply_policy(rule_ledger(rows, text), policy).filter("kept").select("_row.*")


def ablations(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: rows it fails, rows only it fails, rows kept without it.

    The ledger is reduced to one count per mask, so what is compared is at most 2 ** rules
    rows.  An empty ledger gives zeros.
    """
    whole, order = mask_of(POLICIES[policy]), list(rules())
    masks = ledger.groupBy("failed_mask").agg(F.count(F.lit(1)).alias("rows"))
    own = F.col("failed_mask").bitwiseAND(F.lit(whole))
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("rows"))), F.lit(0))
    found = []
    for name in POLICIES[policy]:
        bit = 1 << order.index(name)
        found.append(
            F.struct(
                F.lit(name).alias("rule"),
                count(own.bitwiseAND(F.lit(bit)) != 0).alias("failed"),
                count(own == bit).alias("failed_alone"),
                count(own.bitwiseAND(F.lit(whole & ~bit)) == 0).alias("kept_without"),
            )
        )
    return masks.agg(F.array(*found).alias("rules")).select(F.explode("rules").alias("r")).select("r.*")


SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS body,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents
), places AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM cut WHERE len(words) >= 3
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
  FROM places
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM windows, (VALUES (0), (1), (2)) AS t(k) WHERE n > 1 GROUP BY doc_id
), ledger AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len(lines)::BIGINT AS n_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN covered USING (doc_id)
), masks AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed_mask
  FROM ledger
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_mask,
  (failed_mask & 3) <> 0 AS base_failed, (failed_mask & 63) = 0 AS kept
FROM masks
"""


@query("op5_rule_ledger", SQL)
def op5_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger and verdict of the current policy for every document."""
    documents = load(spark, folder, "documents").select("doc_id", "text")
    return apply_policy(rule_ledger(documents)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "failed_mask",
        fails("base").alias("base_failed"),
        "kept",
    )
