"""Text normalisation and character n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Noise words removed as whole words from similarity text.
NOISE_WORDS = ["hospital", "center", "medical", "health", "system", "regional", "community"]

# Noise substrings removed anywhere, in this order, from names
# used as a join key.
NOISE_SUBSTRINGS = [
    "hospital", "medical", "center", "health", "regional", "rural",
    "emergency", "community", "general", "memorial", "critical", "access",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c) -> Column:
    """lower-case, every non-word non-space char -> space, squeeze, trim.
    NULL -> ''. ``(?U)`` makes \\w Unicode-aware like Python's ``re``."""
    s = F.lower(F.coalesce(_c(c).cast("string"), F.lit("")))
    s = F.regexp_replace(s, r"(?U)[^\w\s]", " ")
    s = F.regexp_replace(s, r"(?U)\s+", " ")
    return F.trim(s)


def drop_noise_words(c, words=NOISE_WORDS) -> Column:
    """Remove whole noise words from normalised text, then trim (inner
    double spaces are harmless: n-gramming splits on whitespace)."""
    pattern = r"(?U)\b(" + "|".join(words) + r")\b"
    return F.trim(F.regexp_replace(_c(c), pattern, ""))


def similarity_text(*cols, null_token: str = "") -> Column:
    """Concatenate fields with spaces, normalise, drop noise words (PL text build).
    Missing fields become ``null_token`` ('' by default; 'nan' reproduces T16)."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(null_token)) for c in cols]
    return drop_noise_words(normalize_text(F.concat_ws(" ", *parts)))


def name_key(c, substrings=NOISE_SUBSTRINGS) -> Column:
    """Lower, punctuation -> space, noise substrings -> space, squeeze, trim."""
    s = F.lower(F.coalesce(_c(c).cast("string"), F.lit("")))
    s = F.regexp_replace(s, r"(?U)[^\w\s]", " ")
    for w in substrings:
        s = F.replace(s, F.lit(w), F.lit(" "))
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def char_wb_ngrams(c, n_min: int = 3, n_max: int = 4) -> Column:
    """word-bounded character n-grams. Each whitespace-separated word is padded
    with one space on both sides and yields, for every n, its L - n + 1 n-grams when
    its padded length L >= n (so a word of padded length n appears once, whole, and
    larger n are skipped for it); n-grams never cross words. Returns array<string>
    with repeats (term counts). For large inputs prefer ``explode_char_wb``."""
    words = F.filter(F.split(_c(c), r"(?U)\s+"), lambda w: F.length(w) > 0)
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams_of(w: Column) -> Column:
        L = F.length(w)
        per_n = [F.when(L >= n, F.transform(F.sequence(F.lit(1), L - n + 1), lambda i: F.substring(w, i, n)))
                 .otherwise(F.array().cast("array<string>")) for n in range(n_min, n_max + 1)]
        short = F.when(L < n_min, F.array(w)).otherwise(F.array().cast("array<string>"))
        return F.flatten(F.array(short, *per_n))

    return F.flatten(F.transform(padded, grams_of))


def explode_char_wb(df: DataFrame, key: str, text: str, n_min: int = 3, n_max: int = 4) -> DataFrame:
    """F12 as a generator plan: (key, gram) rows, one per n-gram occurrence. Uses
    ``explode`` + ``substring`` (code-generated) instead of nested higher-order
    functions, which Spark evaluates row by row."""
    words = (df.select(F.col(key), F.explode(F.split(F.col(text), r"(?U)\s+")).alias("_w"))
             .where(F.length("_w") > 0)
             .select(key, F.concat(F.lit(" "), F.col("_w"), F.lit(" ")).alias("_w")))
    words = words.withColumn("_L", F.length("_w"))
    parts = []
    for n in range(n_min, n_max + 1):
        parts.append(words.where(F.col("_L") >= n)
                     .select(key, "_w", F.explode(F.sequence(F.lit(1), F.col("_L") - n + 1)).alias("_i"))
                     .select(key, F.substring(F.col("_w"), F.col("_i"), n).alias("gram")))
    parts.append(words.where(F.col("_L") < n_min).select(key, F.col("_w").alias("gram")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
