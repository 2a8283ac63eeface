"""Quality rules: a threshold table compiled into one Spark projection.

``metrics`` are column expressions over the text; ``RULES`` is a table of
(rule, metric, lowest, highest) that ``compile_rules`` turns into one boolean
per rule.  Nothing is joined or shuffled: the verdict is a projection of the
scan, so a document's cost is its own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityzones.llm.common import SPACES, let, unused, word_list

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "it", "with", "be", "for", "this", "was", "are", "as", "by", "on",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "que", "qui", "en", "dans", "pour", "par", "sur", "est",
    "der", "die", "das", "und", "den", "dem", "von", "zu", "mit", "sich", "ein", "eine", "auf", "ist", "im", "nicht",
    "el", "los", "las", "y", "un", "una", "por", "con", "para", "se", "del", "no", "su",
)

# The threshold table: a document passes a rule when lowest <= metric <= highest.
RULES = (
    ("mean_word_length", "mean_word_chars", 2.0, 16.0),
    ("symbol_ratio", "symbols_per_word", None, 0.10),
    ("stop_word_ratio", "stop_words_per_word", 0.01, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.50),
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _repeat_words(words: Column) -> Column:
    """Words inside a 3-word window that occurs at least twice.

    Windows are compared by their 64-bit hash: sorted with their positions,
    equal neighbours are repeats; the union of [p, p + 3) over the repeats'
    positions in order is what they cover."""
    def covered(hashes: Column) -> Column:
        ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def spread(s: Column) -> Column:
            repeats = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
            return let(F.sort_array(F.transform(repeats, lambda x: x["i"])), lambda at: F.aggregate(
                F.transform(at, lambda p, i: F.least(F.coalesce(F.get(at, i + 1) - p, F.lit(3)), F.lit(3))),
                F.lit(0), lambda total, n: total + n))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(ranked, spread))

    windows = let(words, lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    return F.when(F.size(words) < 4, 0).otherwise(let(windows, covered))


def with_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """Append ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (long) and the ratios
    the rules use.  Null text counts as text without words; every ratio of such a text is 0.

    Columns of the same names are replaced; no other column changes."""
    words_col, lines_col, n_lines_col = (unused(df, c) for c in ("words", "lines", "n_lines"))
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    stop = [F.lit(w) for w in dict.fromkeys(STOP_WORDS)]
    found = df.withColumns({words_col: word_list(F.col(text)), lines_col: lines})
    words, n = F.col(words_col), F.greatest(F.size(words_col), F.lit(1))
    found = found.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": (F.size(lines_col) - F.size(F.array_distinct(lines_col))).cast("long"),
        "n_repeat_words": _repeat_words(words).cast("long"),
        "stop_words_per_word": F.size(F.filter(words, lambda w: F.lower(w).isin(*stop))) / n,
        n_lines_col: F.size(lines_col),
    })
    return found.withColumns({
        "mean_word_chars": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col(n_lines_col), F.lit(1)),
    }).drop(words_col, lines_col, n_lines_col)


def compile_rules(rules=RULES) -> dict[str, Column]:
    """One boolean column per row of the threshold table: does the metric lie inside?"""
    def inside(metric: str, low, high) -> Column:
        ok = F.lit(True)
        if low is not None:
            ok = ok & (F.col(metric) >= low)
        if high is not None:
            ok = ok & (F.col(metric) <= high)
        return ok

    return {f"pass_{name}": inside(metric, low, high) for name, metric, low, high in rules}


def judge(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``df`` with the metrics, ``base_failed``, one ``pass_*`` column per rule and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words repeat.
    ``kept``: not base_failed and every rule passes.  Null and empty texts fail."""
    found = with_metrics(df, text)
    verdicts = compile_rules(rules)
    found = found.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")), **verdicts})
    kept = ~F.col("base_failed")
    for name in verdicts:
        kept = kept & F.col(name)
    return found.withColumn("kept", kept)


def passing(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``df`` that are kept, with their own columns whatever their names."""
    return judge(df.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), "_text", rules) \
        .where("kept").select("_row.*")


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    words = "', '".join(dict.fromkeys(STOP_WORDS))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT r, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS s
      FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g),
p AS (SELECT r, count(DISTINCT i + k) AS n FROM c, unnest([0, 1, 2]) AS v(k) WHERE c.n > 1 GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ('{words}'))) AS n_stop, len(l) AS n_lines
  FROM d LEFT JOIN p USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 16
       AND n_symbols / greatest(n_words, 1) <= 0.10
       AND n_stop / greatest(n_words, 1) >= 0.01
       AND n_dup_lines / greatest(n_lines, 1) <= 0.50 AS kept
FROM b"""


QUERIES = {"op4_quality_rules": op4_quality_rules}
ORACLE = {"op4_quality_rules": _sql()}
