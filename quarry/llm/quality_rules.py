"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Everything is computed inside the row from the whole text; nothing is shuffled. Repeated
3-word windows are found by sorting the window hashes of one text (64-bit, so two
different windows of one text collide with a probability under 1e-10 for 20,000 words).

Defined cases: a NULL text counts as empty (all counts 0, base_failed); NULL ids are kept;
repeated rows are judged each on its own; an empty table gives an empty result; the
columns this operator adds replace columns of the same name. The stop-word rule judges only
texts whose ``lang`` is one of ``LANGUAGES``; it says nothing about other languages and texts
without a language.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import BLANK, let, read, words

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that it for was on with as by at be this from or an are not have he you they "
    "le la les de des du et un une en que qui dans pour pas sur est au par ce il elle "
    "der die das und ist nicht ein eine zu den von mit im auf dem des sich es für als "
    "el los las y que un una por con para se no su al lo como más es del en"
).split()
#: The tags of these languages (ISO 639), without region or script.
LANGUAGES = ("en", "eng", "fr", "fra", "fre", "de", "deu", "ger", "es", "spa")


class Rule(NamedTuple):
    """A document fails if ``share`` of ``per`` (both counts) is outside [low, high].

    A rule with ``languages`` judges texts of those alone."""

    name: str
    count: str
    per: str | None
    low: float
    high: float
    languages: tuple[str, ...] | None = None


#: Production thresholds. Each is far from what running prose shows, so that only junk fails.
RULES = (
    Rule("words", "n_words", None, 50, math.inf),
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", 0.0, 0.10),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, 1.0, LANGUAGES),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 0.0, 0.50),
    Rule("repeated_windows", "n_repeat_words", "n_words", 0.0, 0.50),
)


def _repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice in the text."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        at = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        repeated = let(at, lambda s: F.transform(
            F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])), lambda x: x["i"]))
        gaps = let(F.sort_array(repeated), lambda r: F.transform(
            r, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(r, j + 1) - x, F.lit(3)))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(some)


def measures(text: Column) -> Column:
    """A struct of the counts of one text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")
    long = lambda c, name: c.cast("long").alias(name)
    return let(words(text), lambda w: let(lines, lambda ln: F.struct(
        long(F.size(w), "n_words"),
        long(F.length(F.array_join(w, "")), "word_chars"),
        long(F.regexp_count(t, F.lit(r"[#*$%&|<>]")), "n_symbols"),
        long(F.size(ln), "n_lines"),
        long(F.size(ln) - F.size(F.array_distinct(ln)), "n_dup_lines"),
        long(_repeat_words(w), "n_repeat_words"),
        long(F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))), "n_stop_words"))))


def verdict(m: Column, lang: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a text of that language breaks."""
    tag = F.split(F.lower(F.btrim(lang)), "[-_]")[0]
    broken = []
    for r in rules:
        x = m[r.count] if r.per is None else m[r.count] / F.greatest(m[r.per], F.lit(1))
        outside = (x < r.low) | (x > r.high)
        broken.append(F.when(outside if r.languages is None else outside & tag.isin(*r.languages), F.lit(r.name)))
    return F.array_compact(F.array(*broken))


def _lang(docs: DataFrame) -> Column:
    return F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 50, max_repeat_pct: int = 50) -> DataFrame:
    """docs with the counts, ``base_failed``, ``broken_rules`` (names) and ``kept``."""
    fields = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")
    out = docs.withColumn("__m", measures(F.col("text")))
    m = F.col("__m")
    out = out.withColumns({f: m[f] for f in fields} | {
        "base_failed": (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat_pct * m["n_words"]),
        "broken_rules": verdict(m, _lang(docs), rules)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)).drop("__m")


def keeps(text: Column, lang: Column, rules: tuple[Rule, ...] = RULES, min_words: int = 50, max_repeat_pct: int = 50) -> Column:
    """``kept`` of ``judge`` as one expression. A filter on the column ``kept`` would be pushed below
    the projection and compute the measures once for every count that a rule names."""
    fine = lambda m: (m["n_words"] >= min_words) & (100 * m["n_repeat_words"] <= max_repeat_pct * m["n_words"])
    return let(measures(text), lambda m: fine(m) & (F.size(verdict(m, lang, rules)) == 0))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that break a rule go."""
    return docs.filter(keeps(F.col("text"), _lang(docs)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in dict.fromkeys(values))


def _sql_rule(r: Rule) -> str:
    share = r.count if r.per is None else f"{r.count} / greatest({r.per}, 1)"
    fine = f"{share} >= {r.low}" + ("" if r.high == math.inf else f" AND {share} <= {r.high}")
    return f"({fine})" if r.languages is None else f"(NOT coalesce(tag IN ({_sql_list(r.languages)}), false) OR ({fine}))"


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split_regex(lower(trim(lang)), '[-_]')[1] AS tag, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, doc_id, text, tag, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM d),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (
            SELECT rid, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) o(k) GROUP BY rid),
m AS (SELECT doc_id, tag, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ln) AS n_lines,
             len(ln) - len(list_distinct(ln)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN ({_sql_list(STOP_WORDS)}))) AS n_stop_words
      FROM w LEFT JOIN cov USING (rid)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(map(_sql_rule, RULES))} AS kept
FROM b
"""
