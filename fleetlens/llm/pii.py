"""Personal data in texts: known forms, and terms that give protected entities away; Spark expressions only.

Base spans are e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone numbers.  Their values are the protected
*entities*.  The terms (words) of a document with an entity are candidates for disclosure: even with the entity masked, a term
that occurs with it and hardly anywhere else reveals it, wherever it stands.  Over the whole corpus,

    p(e|t) = documents that contain t and e / documents that contain t,
    bits(t, e) = log2(p(e|t) / p(e)),    p(e) = documents that contain e / documents,

and a term is generalised in every document if p(e|t) >= `share`, bits >= `bits`, and documents with at least `support` different
contexts show it.  A context is what stands around the entity, and the term's neighbours: copies of one text or passage have one
context, so they alone make no term revealing.

Spans are found per document (doc_id and a hash of the text); rows that agree in both share them.  Of the texts only those go
through a shuffle, once each, that a Bloom filter of the hashes sought lets through: texts with entities, texts with flagged terms.

A null or empty text has no spans.  Repeated documents give repeated rows, and count as documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.llm.common import KeyFilter, checkpointed
from fleetlens.llm.spans import SPAN, all_matches, as_text, in_order, of_kind, only, placed, redacted, uncovered

KINDS = ["email", "ip", "card", "phone", "term"]

# Fixed patterns of the base spans.  \G lets a match begin where the last one ended, inside a run.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

TERM = r"[\p{L}\p{N}]{2,}+"
#: Characters before and after an entity that tell copies of one passage from others; terms are sought in whole documents.
CONTEXT = 60
#: Flagged terms up to which every task gets all of them; more are joined by key.
SHARED_TERMS = 100_000


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_ip(value: Column) -> Column:
    # Leading zeros don't count; more than three other digits are above 255.
    part = F.transform(F.split(value, "\\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return ~F.exists(part, lambda p: (F.char_length(p) > 3) | (p.try_cast("int") > 255))


def _is_card(value: Column) -> Column:
    """12 to 19 digits of which the Luhn sum is a multiple of ten."""

    def luhn(digits: Column) -> Column:
        def add(total: Column, i: Column) -> Column:
            digit = F.substring(digits, i, F.lit(1)).cast("int")
            twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
            return total + F.when((F.char_length(digits) - i) % 2 == 1, twice).otherwise(digit)

        return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0

    digits = _digits(value)
    return F.when(F.char_length(digits).between(12, 19), luhn(digits)).otherwise(False)


def _is_phone(value: Column) -> Column:
    return F.char_length(_digits(value)).between(9, 15)


def _entity(kind: Column, value: Column) -> Column:
    """An entity in one spelling: e-mail in lower case, numbers as their digits."""
    plain = F.when(kind == 0, F.lower(value)).when(kind == 1, value).otherwise(_digits(value))
    return F.concat_ws(":", kind.cast("string"), plain)


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, `base` spans (start, kind, end, value) in order, and entity and context of each (`contexts`); without the text."""
    text = F.col("text")
    none = F.array().cast("array<string>")
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")).select(
        "doc_id",
        "text",
        F.when(text.contains("@"), all_matches(text, EMAIL)).otherwise(none).alias("m0"),
        all_matches(text, IP).alias("m1"),
        all_matches(text, CARD).alias("m2"),
        F.when(text.contains("+"), all_matches(text, PHONE)).otherwise(none).alias("m3"),
    )
    # A text is split for a kind only if one of its matches passes.
    tests = [(EMAIL, lambda v: F.lit(True)), (IP, _is_ip), (CARD, _is_card), (PHONE, _is_phone)]
    spans = []
    for k, (pattern, keep) in enumerate(tests):
        found = F.col(f"m{k}")
        some = F.exists(found, keep)
        spans.append(F.when(some, only(placed(text, found, pattern, k), keep)).otherwise(F.array().cast(SPAN)))
    rows = rows.select("doc_id", "text", in_order(*spans).alias("base"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "base", F.transform("base", _context).alias("contexts"))


def _context(span: Column) -> Column:
    low = F.greatest(span["start"] - CONTEXT, F.lit(0))
    high = F.least(span["end"] + CONTEXT, F.char_length("text").cast("long"))
    around = F.substring(F.col("text"), (low + 1).cast("int"), (high - low).cast("int"))
    return F.struct(_entity(span["kind"], span["value"]).alias("entity"), F.xxhash64(around).alias("around"))


def _terms(texts: DataFrame) -> DataFrame:
    """(text_hash, term, beside): the terms of each text outside of its base spans, and a hash of the neighbours of one place."""
    # Without the names of kinds, so that these are no terms.
    rows = texts.select("text_hash", F.lower(redacted(F.col("text"), F.col("base"), [""] * len(KINDS))).alias("text"))
    rows = rows.select("text_hash", all_matches(F.col("text"), TERM).alias("words"))
    beside = F.transform(
        "words",
        lambda word, i: F.struct(
            word.alias("term"), F.xxhash64(F.get("words", i - 1), F.get("words", i + 1)).alias("beside")
        ),
    )
    rows = rows.select("text_hash", F.explode(beside).alias("t")).select("text_hash", "t.*")
    return rows.groupBy("text_hash", "term").agg(F.min("beside").alias("beside"))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df): in how many documents a term occurs.  A document's terms are made distinct before they are exploded."""
    terms = F.array_distinct(all_matches(F.lower(docs["text"]), TERM))
    return docs.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def revealing(docs: DataFrame, scanned: DataFrame, share: float, bits: float, support: int) -> DataFrame:
    """The (entity, term) pairs whose term reveals the entity.

    Equal texts are one text of so many documents.  Before texts and terms meet, entities and terms go that no pair can have.
    """
    documents = max(docs.count(), 1)
    texts = scanned.where(F.size("base") > 0).groupBy("text_hash").agg(
        F.count(F.lit(1)).alias("n"), F.first("base").alias("base"), F.first("contexts").alias("contexts")
    )
    texts = checkpointed(texts)
    held = texts.select("text_hash", "n", F.explode("contexts").alias("c")).select("text_hash", "n", "c.*")
    held = held.groupBy("text_hash", "n", "entity").agg(F.min("around").alias("around"))
    entities = held.groupBy("entity").agg(F.sum("n").alias("entity_docs"), F.count(F.lit(1)).alias("texts"))
    # p(e|t) is 1 at most, and a text has one context of a pair.
    entities = entities.where((F.col("texts") >= support) & (-F.log2(F.col("entity_docs") / F.lit(documents)) >= bits))
    held = checkpointed(held.join(entities.select("entity", "entity_docs"), "entity"))

    wanted = texts.join(held.select("text_hash"), "text_hash", "left_semi").select("text_hash", "n", "base")
    content = docs.select(_text_hash(docs["text"]).alias("text_hash"), docs["text"].alias("text"))
    content = KeyFilter.of(wanted.select("text_hash")).mark(content, F.col("text_hash")).where("__maybe")
    # Copies become one row where they lie; the join drops what the filter let through in vain.
    content = content.groupBy("text_hash").agg(F.first("text").alias("text"))
    terms = checkpointed(_terms(content.join(wanted, "text_hash")))
    # In the documents of all entities together a term must have its share, too.
    able = terms.join(wanted.select("text_hash", "n"), "text_hash").groupBy("term").agg(
        F.sum("n").alias("docs"), F.count(F.lit(1)).alias("texts")
    )
    able = able.where(F.col("texts") >= support).join(document_frequencies(docs), "term")
    able = checkpointed(able.where(F.col("docs") >= F.col("df") * share).select("term", "df"))

    pairs = terms.join(able.select("term"), "term", "left_semi").join(held, "text_hash")
    # Documents per context first: a context that thousands of copies share becomes one row before it is counted.
    seen = pairs.groupBy("entity", "entity_docs", "term", F.xxhash64("around", "beside").alias("context"))
    seen = seen.agg(F.sum("n").alias("docs"))
    seen = seen.groupBy("entity", "entity_docs", "term").agg(F.count(F.lit(1)).alias("contexts"), F.sum("docs").alias("docs"))
    seen = seen.where(F.col("contexts") >= support).join(able, "term")
    given = F.least(F.col("docs"), F.col("df")) / F.col("df")
    gain = F.log2(given / (F.col("entity_docs") / F.lit(documents)))
    return seen.where((given >= share) & (gain >= bits)).select("entity", "term")


def _marked(docs: DataFrame, flagged: DataFrame) -> DataFrame:
    """(added_id, added_hash, added): the places of flagged terms in all documents that have any."""
    # One key, so that the text is dealt once; structs that hold the same null are equal.
    key = F.struct(docs["doc_id"].alias("id"), _text_hash(docs["text"]).alias("hash")).alias("key")
    rows = docs.select(key, docs["text"].alias("text"))
    terms = checkpointed(flagged.select("term").distinct())
    count = terms.count()
    if count <= SHARED_TERMS:
        terms = F.broadcast(terms)
    words = rows.select("key", F.explode(F.array_distinct(all_matches(F.col("text"), TERM))).alias("word"))
    words = words.join(terms, F.lower("word") == F.col("term")).groupBy("key").agg(F.collect_set("word").alias("words"))
    words = checkpointed(words)
    found = KeyFilter.of(words.select(F.col("key.hash").alias("hash"))).mark(rows, F.col("key.hash")).where("__maybe")
    # Repeated rows of an id have one text: one of them is enough.
    found = found.groupBy("key").agg(F.first("text").alias("text")).join(words, "key")
    # As they are spelt in this document; terms consist of letters and digits.
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join("words", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    found = found.select("key", "text", pattern.alias("pattern"))
    matches = F.regexp_extract_all("text", F.col("pattern"), F.lit(0))
    added = placed(F.col("text"), matches, F.col("pattern"), KINDS.index("term")).alias("added")
    return found.select(F.col("key.id").alias("added_id"), F.col("key.hash").alias("added_hash"), added)


def find_personal_data(docs: DataFrame, share: float = 0.5, bits: float = 4.0, support: int = 2) -> DataFrame:
    """doc_id, text_hash, `base` spans and all `spans` in order (start, kind, end, value) per row of `docs`.

    The scan runs once; what it found is checkpointed without the texts.
    """
    scanned = checkpointed(scan(docs))
    added = _marked(docs, revealing(docs, scanned, share, bits, support))
    same = scanned["doc_id"].eqNullSafe(added["added_id"]) & (scanned["text_hash"] == added["added_hash"])
    # Parts of base spans are masked already.
    free = uncovered(F.col("added"), F.col("base"), KINDS.index("term"))
    free = F.transform(free, lambda t: F.struct(t["start"], t["kind"], t["end"], F.lower(t["value"]).alias("value")))
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(in_order(F.col("base"), free.cast(SPAN)))
    return scanned.join(added, same, "left").select("doc_id", "text_hash", "base", spans.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, a digest of the base spans, and all spans as text."""
    return found.select(
        "doc_id",
        *[of_kind(F.col("base"), k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(as_text(F.col("base"), KINDS), 256).alias("base_sha256"),
        as_text(F.col("spans"), KINDS).alias("spans"),
    )


def sanitised(docs: DataFrame, share: float = 0.5, bits: float = 4.0, support: int = 2) -> DataFrame:
    """doc_id and text of every row, with [KIND] in place of entities and [TERM] in place of terms that reveal them."""
    spans = find_personal_data(docs, share, bits, support).where(F.size("spans") > 0)
    spans = spans.select(F.col("doc_id").alias("span_id"), "text_hash", "spans").dropDuplicates(["span_id", "text_hash"])
    text = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    same = text["doc_id"].eqNullSafe(spans["span_id"]) & (F.xxhash64(text["text"]) == spans["text_hash"])
    new = F.when(F.col("spans").isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col("spans"), KINDS))
    return text.join(spans, same, "left").select("doc_id", new.alias("text"))
