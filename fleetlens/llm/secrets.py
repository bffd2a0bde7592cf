"""Secrets in texts: known forms, and strings that a battery of randomness tests takes for random; Spark expressions only.

Base spans are assignments, access keys and long hex runs.  Beyond them every run of at least `MIN_LENGTH` characters of the
base64 alphabets with a letter and a digit is a candidate.  Its *encoding* (hex, base32 or base64) is inferred from its
characters.  Under the hypothesis of independent uniform characters of that encoding's alphabet three tests apply: chi-squared
over the alphabet, runs of lower and upper half of the alphabet, and serial correlation of neighbours.  Their squared normal
deviates sum up to one p-value: small for words, paths and identifiers, spread evenly over 0..1 for random strings.

False discoveries are controlled by length: for each length class the histogram of the p-values of all distinct candidates in
the corpus (a table of fixed size) tells how many random strings there are, as the upper half holds little else, and so how many others lie
above each threshold.  The least threshold that keeps their share below `fdr` counts; there may be none.

A null or empty text has no spans.  Repeated documents give repeated rows.  A string counts once in the histogram, however
often it occurs; the thresholds hold for all its occurrences.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.llm.common import checkpointed
from fleetlens.llm.spans import SPAN, all_matches, as_text, in_order, of_kind, only, placed, redacted, uncovered

KINDS = ["assign", "access", "hex", "random"]

# Fixed patterns of the base spans.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"  # as the shorter run of a failing match can't hold a longer one
HEX = r"(?:(?<![0-9a-f])|\G)[0-9a-f]{24,}+"

MIN_LENGTH = 20
CANDIDATE = rf"(?:(?<![A-Za-z0-9+/_-])|\G)[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}+"

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The alphabets by encoding, smallest first.  Letters of hex may be in either case; `-_` stand for `+/`.
ALPHABETS = {"hex": _DIGITS + "abcdef", "base32": _UPPER + "234567", "base64": _UPPER + _LOWER + _DIGITS + "+/"}
#: Upper ends of the length classes (the last one is open), and bins of p-values.
LENGTHS = [24, 32, 48, 64, 128]
BINS = 40


def _sum(parts) -> Column:
    return functools.reduce(operator.add, parts)


def encoding(value: Column) -> Column:
    """The encoding that the characters of `value` suggest."""
    is_hex, is_base32 = value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), value.rlike("^[A-Z2-7]+$")
    return F.when(is_hex, "hex").when(is_base32, "base32").otherwise("base64")


def p_value(value: Column) -> Column:
    """How well `value` agrees with independent uniform characters of the alphabet its characters suggest."""
    is_hex, is_base32 = encoding(value) == "hex", encoding(value) == "base32"
    normal = F.when(is_hex, F.lower(value)).otherwise(F.translate(value, "-_", "+/"))
    alphabet = F.when(is_hex, ALPHABETS["hex"]).when(is_base32, ALPHABETS["base32"]).otherwise(ALPHABETS["base64"])
    size = F.char_length(alphabet).cast("double")

    codes = F.transform(
        F.sequence(F.lit(1), F.char_length(value)),
        lambda i: (F.position(F.substring(normal, i, F.lit(1)), alphabet) - 1).cast("double"),
    )
    # Bound once: codes, alphabet size and its letters.
    bound = F.array(F.struct(codes.alias("x"), size.alias("a"), alphabet.alias("letters"), normal.alias("s")))
    return F.transform(bound, lambda v: _battery(v["x"], v["a"], v["letters"], v["s"]))[0]


def _battery(x: Column, a: Column, letters: Column, s: Column) -> Column:
    n = F.size(x).cast("double")
    counts = F.transform(
        F.sequence(F.lit(1), F.char_length(letters)),
        lambda i: (F.char_length(s) - F.char_length(F.replace(s, F.substring(letters, i, F.lit(1)), F.lit("")))).cast("double"),
    )
    squares = F.aggregate(counts, F.lit(0.0), lambda total, c: total + c * c)
    chi = a / n * squares - n
    z_chi = (chi - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)

    upper = F.aggregate(x, F.lit(0.0), lambda total, c: total + F.when(c >= a / 2, 1.0).otherwise(0.0))
    pairs = F.arrays_zip(F.slice(x, 1, F.size(x) - 1).alias("u"), F.slice(x, 2, F.size(x) - 1).alias("v"))
    changes = F.aggregate(
        pairs, F.lit(1.0), lambda total, p: total + F.when((p["u"] >= a / 2) != (p["v"] >= a / 2), 1.0).otherwise(0.0)
    )
    mean = 2 * upper * (n - upper) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = F.when(spread > 0, (changes - mean) / F.sqrt(spread)).otherwise(F.lit(9.0))

    middle = (a - 1) / 2
    around = F.aggregate(pairs, F.lit(0.0), lambda total, p: total + (p["u"] - middle) * (p["v"] - middle))
    z_serial = around / ((a * a - 1) / 12) / F.sqrt(n - 1)

    # Sum of three squares to a normal deviate by the cube root, then to a tail by a logistic curve.
    total = (z_chi * z_chi + z_runs * z_runs + z_serial * z_serial) / 3
    z = (F.pow(total, 1 / 3) - (1 - 2 / 27)) / (2 / 27) ** 0.5
    return 1 / (1 + F.exp(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(500.0))))


def length_class(length: Column) -> Column:
    return _sum([(length > end).cast("int") for end in LENGTHS])


def scan(docs: DataFrame) -> DataFrame:
    """Per document: its columns, `base` spans (kinds 0-2), and `candidates` (spans of kind 3 with length class and bin)."""
    row = F.struct(*[docs[name].alias(name) for name in docs.columns]).alias("row")
    text = F.col("text")
    rows = docs.select(row, F.coalesce(docs["text"], F.lit("")).alias("text"))
    rows = rows.select(
        "row",
        "text",
        all_matches(text, ASSIGN).alias("m0"),
        F.when(text.contains("AKIA"), all_matches(text, ACCESS)).otherwise(F.array().cast("array<string>")).alias("m1"),
        all_matches(text, HEX).alias("m2"),
        all_matches(text, CANDIDATE).alias("m3"),
    )
    # What is to be tested is decided by the matches alone, so that most texts aren't split.
    assigned = only(placed(text, F.col("m0"), ASSIGN, 0), lambda v: F.char_length(F.regexp_extract(v, ASSIGN, 1)) >= 6)
    mixed = F.exists("m3", lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]"))
    runs = F.when(mixed, placed(text, F.col("m3"), CANDIDATE, 3)).otherwise(F.array().cast(SPAN))
    rows = rows.select(
        "row",
        "text",
        in_order(assigned, placed(text, F.col("m1"), ACCESS, 1), placed(text, F.col("m2"), HEX, 2)).alias("base"),
        only(runs, lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")).alias("runs"),
    )
    # What a base span covers is found already.
    free = uncovered(F.col("runs"), F.col("base"), KINDS.index("random"))
    tested = F.transform(
        free,
        lambda r: F.struct(
            r["start"], r["kind"], r["end"], r["value"], length_class(r["end"] - r["start"]).alias("length_class"),
            F.least(F.floor(p_value(r["value"]) * BINS), F.lit(BINS - 1)).cast("int").alias("bin"),
        ),
    )
    return rows.select("row", "text", "base", tested.alias("candidates"))


def thresholds(scanned: DataFrame, fdr: float) -> dict[int, int]:
    """By length class the least bin from which on candidates count as random; a class may have none.

    The driver gets one row per length class and bin.
    """
    distinct = scanned.select(F.explode("candidates").alias("c"))
    distinct = distinct.select("c.length_class", "c.bin", F.xxhash64("c.value").alias("value")).distinct()
    cells = distinct.groupBy("length_class", "bin").count().collect()
    out = {}
    for k in range(len(LENGTHS) + 1):
        counts = [0] * BINS
        for row in cells:
            if row["length_class"] == k:
                counts[row["bin"]] = row["count"]
        random = 2 * sum(counts[BINS // 2 :]) / BINS  # per bin
        for b in range(1, BINS // 2 + 1):
            above = sum(counts[b:])
            if above and above - random * (BINS - b) <= fdr * above:
                out[k] = b
                break
    return out


def find_secrets(docs: DataFrame, fdr: float = 0.1) -> DataFrame:
    """Per document: its columns in `row`, `text`-free `base` and all `spans` in order (start, kind, end, value).

    The scan runs once; what it found is checkpointed without the texts.
    """
    found = checkpointed(scan(docs).drop("text"))
    random = _random(thresholds(found, fdr))
    return found.select("row", "base", in_order(F.col("base"), random).alias("spans"))


def _random(least: dict[int, int]) -> Column:
    """The candidates at or above the threshold of their length class, as spans."""
    passes = F.create_map(*[F.lit(x) for pair in (least or {-1: BINS}).items() for x in pair])
    return F.transform(
        F.filter("candidates", lambda c: c["bin"] >= F.coalesce(passes[c["length_class"]], F.lit(BINS))),
        lambda c: F.struct(*[c[name].alias(name) for name in ("start", "kind", "end", "value")]),
    )


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, a digest of the base spans, and all spans as text."""
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[of_kind(F.col("base"), k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(as_text(F.col("base"), KINDS), 256).alias("base_sha256"),
        as_text(F.col("spans"), KINDS).alias("spans"),
        F.array_join(F.transform("base", _tested), ",").alias("base_tests"),
    )


def _tested(span: Column) -> Column:
    """encoding:p of a base span's value, or `other` if it has characters of no encoding: what the battery makes of known secrets."""
    secret = F.when(span["kind"] == 0, F.regexp_extract(span["value"], ASSIGN, 1)).otherwise(span["value"])

    def shown(value: Column) -> Column:
        tested = F.concat_ws(":", encoding(value), F.format_string("%.4f", p_value(value)))
        return F.when(value.rlike("^[A-Za-z0-9+/_-]{6,}$"), tested).otherwise("other")

    return F.transform(F.array(secret), shown)[0]


def without_secrets(docs: DataFrame, fdr: float = 0.1) -> DataFrame:
    """The documents, with all their columns and in full number, with [KIND] in place of each secret; n_chars follows."""
    least = thresholds(checkpointed(scan(docs).select("candidates")), fdr)
    scanned = scan(docs)
    random = _random(least)
    spans = scanned.select("row", "text", in_order(F.col("base"), random).alias("spans"))
    hit = F.size("spans") > 0
    spans = spans.select("row", hit.alias("hit"), redacted(F.col("text"), F.col("spans"), KINDS).alias("redacted"))
    new = {"text": F.col("redacted"), "n_chars": F.char_length("redacted")}
    return spans.select(
        *[
            F.when(F.col("hit"), new[name]).otherwise(F.col("row")[name]).cast(docs.schema[name].dataType).alias(name)
            if name in new else F.col("row")[name].alias(name)
            for name in docs.columns
        ]
    )
