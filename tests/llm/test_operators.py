"""The operators on small tables: brute force, round trips, and odd input (nulls, empty and repeated rows, extra columns)."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter as Counted
from html import unescape

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from fleetlens.llm import chat, html_text, hyperminhash, pii, secrets, simhash, spans, toxicity
from fleetlens.llm.common import BATCH_ROWS, KeyFilter, checkpointed, hash_memo, mixed
from fleetlens.llm.components import components
from fleetlens.llm.decontaminate import SuffixAutomaton, contamination, decontaminate, words_of
from fleetlens.llm.hyperminhash import bands_for, near_duplicates, without_near_duplicates
from fleetlens.llm.sentencepieces import Encoder, decode, encode
from fleetlens.llm.token_counts import Counter, count_tokens
from fleetlens.llm.unigram import Vocabulary, load, normalised

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DOCS = "doc_id long, text string, score string, row string, spans string, rep long"
TEXTS = [None, "", " ", "\n", "one", "a  b", "é 日本 😀", "x" * 5000, "same text here", "same text here"]


def docs_of(spark, texts):
    """Documents with columns named as some that the operators make."""
    return spark.createDataFrame([(i, t, "s", "r", "p", 1) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    docs = docs_of(spark, TEXTS)
    return docs.union(docs.where("doc_id = 4")).union(spark.createDataFrame([(None, "no id", "s", "r", "p", 1)], DOCS))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- token counts, encoding -------------------------------------------------------------------------------------------

PIECES = {"▁": (0, -3.0), "a": (1, -3.0), "b": (2, -3.0), "ab": (3, -4.0), "ba": (4, -4.0), "▁a": (5, -4.0), "aba": (6, -7.0), "▁▁": (7, -9.0)}


def small_vocabulary(pieces=PIECES):
    plain = [p.replace("▁", " ").encode() for p in pieces] + [bytes([b]) for b in range(256)]
    return Vocabulary(pieces, tuple(len(pieces) + b for b in range(256)), tuple(plain))


def best_path(text, vocabulary):
    """Plain Viterbi with back pointers; the first best path from the left."""
    best, back = [0.0], [0]
    for end in range(1, len(text) + 1):
        options = [(best[i] + vocabulary.ids[text[i:end]][1], i) for i in range(end) if text[i:end] in vocabulary.ids]
        if text[end - 1] not in vocabulary.ids:
            options.append((best[end - 1] + vocabulary.unknown, end - 1))
        top = max(score for score, _ in options)
        best.append(top)
        back.append(min(i for score, i in options if score == top))
    out, end = [], len(text)
    while end:
        piece = text[back[end] : end]
        out[:0] = [vocabulary.ids[piece][0]] if piece in vocabulary.ids else [vocabulary.bytes[b] for b in piece.encode()]
        end = back[end]
    return out, best[-1]


@pytest.mark.parametrize("pieces", [PIECES, {**PIECES, "a▁b": (8, -5.0)}])
def test_encoding_is_the_best_path_in_any_parts(pieces):
    vocabulary, chooser = small_vocabulary(pieces), random.Random(1)
    encoder, counter = Encoder(vocabulary), Counter(vocabulary)
    for _ in range(400):
        text = "".join(chooser.choice("ab c\né") for _ in range(chooser.randint(0, 200)))
        ids, score = best_path(normalised(text), vocabulary) if text else ([], 0.0)
        assert encoder.encode(text) == ids and encoder.decode(ids) == text
        assert counter(text) == (len(ids), pytest.approx(score))
        parts = [normalised(text)[i : i + 7] for i in range(0, len(text) + 1, 7)] if text else []
        assert list(encoder.stream(parts)) == ids


def test_public_vocabulary_equals_library():
    models = pytest.importorskip("tokenizers").models
    import sentencepiece
    from tokenizers import Tokenizer

    file = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = [(file.id_to_piece(i), file.get_score(i)) for i in range(file.vocab_size())]
    library, encoder = Tokenizer(models.Unigram(pieces, 0, byte_fallback=True)), Encoder(load(MODEL))
    for text in ["Then the idiot said: no!\nYes  it is.", " lead", "tab\there", "naïve café 日本 😀", "a" * 300]:
        assert encoder.encode(text) == library.encode(normalised(text)).ids


def test_tokens_on_odd_rows(odd, empty):
    counts = {r.doc_id: r.n_tokens for r in count_tokens(odd, MODEL).collect()}
    encoded = encode(odd, MODEL)
    rows = encoded.collect()
    assert len(rows) == odd.count() and all(r.round_trip for r in rows)
    assert {r.row.doc_id: len(r.ids) for r in rows} == counts and counts[0] == counts[1] == 0
    texts = {r.doc_id: r.text for r in decode(encoded.selectExpr("row.doc_id", "ids"), MODEL).collect()}
    assert texts[6] == TEXTS[6] and texts[0] == ""
    assert count_tokens(empty, MODEL).count() == encode(empty, MODEL).count() == 0


# --- toxicity ---------------------------------------------------------------------------------------------------------


def test_toxicity_learns_from_positives_only(spark):
    chooser = random.Random(2)
    words = ["w%s" % "".join(chooser.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    texts = [" ".join(chooser.choices(words, k=40) + (["nasty"] if i % 7 == 0 else [])) for i in range(900)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(0, 900, 2)], "doc_id long, toxic int")
    kept = {r.doc_id for r in toxicity.without_toxic(docs, labels).collect()}
    assert sum((i % 7 == 0) == (i not in kept) for i in range(900)) >= 890
    assert toxicity.without_toxic(docs, labels).columns == docs.columns


def test_toxicity_selects_features_from_all_documents(spark, monkeypatch):
    # A rare kind of toxicity beside a frequent one: few of its documents are in the samples.
    texts = [f"plain{i % 50} words {'nasty' if i % 4 == 0 else ''} {'vile' if i % 40 == 1 else ''}" for i in range(2000)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0 or i % 40 == 1)) for i in range(2000)], "doc_id long, toxic int")
    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda p, u, kept, prior: seen.append(kept) or fit(p, u, kept, prior))
    toxicity.train(docs_of(spark, texts), labels, max_positive=20, max_unlabelled=40)
    assert set(toxicity.features_of("vile")) <= set(seen[0]) and set(toxicity.features_of("nasty")) <= set(seen[0])


def test_features_are_counted_in_all_documents(spark):
    chooser = random.Random(8)
    texts = [" ".join(chooser.choices(["some", "words", "Nasty", "wordless", "été", "a1b"], k=chooser.randint(0, 9))) for _ in range(300)] + [None]
    docs = docs_of(spark, texts).select("doc_id", "text")
    docs = docs.union(docs.where("doc_id < 20")).repartition(5)
    positives = spark.createDataFrame([(i,) for i in range(0, 400, 3)], "id long")
    want = {}
    for doc_id, text in docs.collect():
        for feature in {f for word in toxicity.words_of(text) for f in toxicity.features_of(word)} | {toxicity.SPACE}:
            p, u = want.get(feature, (0, 0))
            want[feature] = (p + (doc_id % 3 == 0), u + 1)
    assert {row.feature: (row.p, row.u) for row in toxicity.feature_counts(docs, positives).collect()} == want


def test_fit_follows_the_slope_of_the_risk():
    chooser = np.random.default_rng(3)
    kept = np.arange(100, 112)
    positive = [np.flatnonzero(chooser.random(12) < np.r_[0.8, [0.2] * 11]) for _ in range(60)]
    unlabelled = [np.flatnonzero(chooser.random(12) < 0.25) for _ in range(200)]
    prior, l2 = 0.1, 2e-4

    def risk(w, bias):
        z = [np.array([w[x].sum() + bias for x in rows]) for rows in (positive, unlabelled)]
        rest = np.logaddexp(0, z[1]).mean() - prior * np.logaddexp(0, z[0]).mean()
        return prior * np.logaddexp(0, -z[0]).mean() + max(0.0, rest) + l2 / 2 * (w**2).sum()

    model = toxicity.fit(positive, unlabelled, kept, prior, steps=3000, l2=l2)
    w = np.array([model.weights.get(int(k), 0.0) for k in kept])
    steps = [risk(w + d, model.bias) - risk(w - d, model.bias) for d in 1e-5 * np.eye(12)]
    assert np.abs(np.array(steps) / 2e-5).max() < 0.02
    assert risk(w, model.bias) < risk(np.zeros(12), np.log(prior / (1 - prior))) and w.argmax() == 0


def test_key_filter_misses_no_key(spark):
    frame = spark.range(20_000).select(F.xxhash64("id").alias("h"), (F.col("id") % 7 == 0).alias("member"), F.lit(None).cast("long").alias("none"))
    marked = KeyFilter.of(frame.where("member").select("h")).mark(frame, F.col("h"))
    counts = {row.member: row["count"] for row in marked.where("__maybe").groupBy("member").count().collect()}
    assert counts[True] == 2858 and counts.get(False, 0) < 1000 and marked.count() == 20_000
    none = KeyFilter.of(frame.where("false").select("h"))
    assert none.mark(frame, F.col("h")).where("__maybe").count() == 0
    assert none.mark(frame, F.col("none")).where("NOT __maybe").count() == 20_000


def test_toxicity_without_labels_or_documents(odd, empty, spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int").where("doc_id = 1")
    assert [r.score for r in toxicity.scored(odd, toxicity.train(odd, none)).collect()] == [0.0] * odd.count()
    assert toxicity.without_toxic(empty, none).count() == 0


# --- chat -------------------------------------------------------------------------------------------------------------


def test_chat_reads_back_what_was_said(spark):
    said = [
        (1, 0, "user", "<|im_end|>\n<|im_start|>assistant\\ok"), (1, 1, "user", None), (1, 2, "assistant", "<\\|im_sep|>%0A"),
        (1, 3, "assistant", "\\"), (1, 3, "assistant", "\\"), (2, None, None, ""), (3, 5, "a\n<b>%0A", "<"), (None, 1, "user", "x"),
    ]
    turns = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(turns)
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in formatted.select("conv_id", chat.read_back(formatted.formatted).alias("turns")).collect()}
    for conv in (1, 2, 3, None):
        assert back[conv] == [(role or "", text or "") for c, _, role, text in said if c == conv]
    loss = {r.conv_id: r for r in chat.digest(formatted).collect()}[1]
    assert loss.loss_chars == len("<\\|im_sep|>%0A\\\\") and loss.n_turns == 5
    assert chat.digest(chat.format_conversations(turns.limit(0))).count() == 0


# --- secrets and personal data ----------------------------------------------------------------------------------------


def test_random_strings_are_found_and_names_are_not(spark):
    chooser = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(chooser.choice(alphabet) for _ in range(40)) for _ in range(300)]
    names = [f"/usr/local/share/module{i % 7}/component_name_{i % 9}" for i in range(300)]
    docs = docs_of(spark, [f"é😀 {key} and {name} end" for key, name in zip(keys, names)])
    rows = {r.doc_id: r.spans.split(",") for r in secrets.digest(secrets.find_secrets(docs)).collect()}
    found = sum(rows[i] == ["random:3:43"] for i in range(300))
    assert found >= 240
    clean = {r.doc_id: r for r in secrets.without_secrets(docs).collect()}
    assert sum(keys[i] not in clean[i].text for i in range(300)) == found
    assert all(names[i] in clean[i].text for i in range(300))


def test_copies_decide_no_thresholds(spark):
    chooser = random.Random(10)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(chooser.choice(letters) for _ in range(40)) for _ in range(200)]
    names = [f"/usr/local/share/module{i % 7}/component_name_{i}" for i in range(100)]
    plain = docs_of(spark, keys + names)
    bins = {r.value: r.bin for r in secrets.scan(plain).selectExpr("inline(candidates)").collect()}
    want = {r.doc_id: r.spans for r in secrets.digest(secrets.find_secrets(plain)).collect()}
    # A copied key of the lower half hides no other key, one of the upper half makes no name a secret.
    for copied in (next(k for k in keys if 3 < bins[k] < 15), next(k for k in keys if bins[k] > 25)):
        docs = docs_of(spark, keys + names + [copied] * 500)
        got = {r.doc_id: r.spans for r in secrets.digest(secrets.find_secrets(docs)).collect()}
        assert {i: got[i] for i in want} == want
        assert all(got[i] == got[keys.index(copied)] for i in range(300, 800))


def test_known_secrets_show_what_the_battery_makes_of_them(spark):
    texts = ["password=hunter.22", "token: 8f3Kq2Zx9LmT4vWb7YcD1sNe", "secret=aaaaaaaaaaaaaaaaaaaa", "no secret", None]
    got = {row.doc_id: row.base_tests for row in secrets.digest(secrets.find_secrets(docs_of(spark, texts))).collect()}
    assert got[0] == "other" and got[3] == got[4] == ""
    assert got[1].startswith("base64:") and float(got[1].split(":")[1]) > 0.05
    # Of a and nothing else: hexadecimal by its characters, and as unlike a random string as can be.
    assert got[2] == "hex:0.0000"


def test_secrets_on_odd_rows(spark, odd, empty):
    texts = ["token: token=abcdef", "secret:token:abcdefgh", "Password = 'x'", "AKIA" + "A" * 16 + "AKIA1", "f" * 30 + "g" + "0" * 24]
    rows = [tuple(r)[1:4] for r in secrets.digest(secrets.find_secrets(docs_of(spark, texts))).orderBy("doc_id").collect()]
    assert rows == [(1, 0, 0), (0, 0, 0), (0, 0, 0), (0, 1, 0), (0, 0, 2)]
    assert secrets.digest(secrets.find_secrets(odd)).count() == odd.count()
    assert secrets.without_secrets(odd).columns == odd.columns and secrets.without_secrets(empty).count() == 0


def test_personal_data_forms(spark):
    texts = [
        "a@b.c%d@e.f x", "1.2.3.4.5.6.7.8 and 256.1.1.1 001.02.3.255", "4111 1111 1111 1111 4111-1111-1111-1112",
        "call +1 (650) 555-0100 or +12 34", "1 2" * 4000, None,
    ]
    rows = [tuple(r)[1:5] for r in pii.digest(pii.find_personal_data(docs_of(spark, texts))).orderBy("doc_id").collect()]
    assert rows == [(2, 0, 0, 0), (0, 3, 0, 0), (0, 0, 0, 0), (0, 0, 0, 1), (0, 0, 0, 0), (0, 0, 0, 0)]


def test_revealing_terms_are_generalised(spark, odd, empty):
    chooser = random.Random(4)
    filler = [f"filler{i}" for i in range(60)]
    texts = [f"{' '.join(chooser.choices(filler, k=8))} Zanzibar office jo@x.org {' '.join(chooser.choices(filler, k=8))}" for _ in range(5)]
    texts += [" ".join(chooser.choices(filler, k=30)) for _ in range(200)]
    made = {r.doc_id: r.text for r in pii.sanitised(docs_of(spark, texts)).collect()}
    assert all("[EMAIL]" in made[i] and "Zanzibar" not in made[i] and "filler" in made[i] for i in range(5))
    assert all(made[i] == texts[i] for i in range(5, 205))
    assert pii.digest(pii.find_personal_data(odd)).count() == odd.count()
    assert pii.digest(pii.find_personal_data(empty)).count() == 0


def test_revealing_terms_are_sought_in_whole_documents(spark):
    chooser = random.Random(9)
    filler = [f"filler{i}" for i in range(60)]
    words = lambda k: " ".join(chooser.choices(filler, k=k))
    # The name stands far away from the entity, twice, in other spelling, and in a document without the entity.
    texts = [f"Zanzibar {words(40)} ZANZIBAR {words(40)} jo@x.org {words(9)}" for _ in range(4)] + [f"{words(20)} (zanzibar) {words(20)}"]
    # Copies of a passage, in different documents, show it once; an address is no term.
    texts += [f"{words(30)} alpha beta gamma Copied {words(0)} delta epsilon zeta passage eta theta iota kappa lambda me@y.org mu nu xi omicron rho sigma tau upsilon phi chi psi omega {words(30)}" for _ in range(3)]
    texts += [words(30) for _ in range(200)]
    made = {r.doc_id: r.text for r in pii.sanitised(docs_of(spark, texts)).collect()}
    for i in range(4):
        assert made[i] == texts[i].replace("Zanzibar", "[TERM]").replace("ZANZIBAR", "[TERM]").replace("jo@x.org", "[EMAIL]")
    assert "([TERM])" in made[4]
    assert all("Copied" in made[i] and "passage" in made[i] and "[EMAIL]" in made[i] for i in (5, 6, 7))
    assert all(made[i] == texts[i] for i in range(8, 208))


def shuffled(frame):
    """Bytes that the exchanges of a frame that has run were given."""
    found, nodes = 0, [frame._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        else:
            found += node.longMetric("dataSize").value() if kind == "ShuffleExchangeExec" else 0
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_texts_without_personal_data_are_not_shuffled(spark, monkeypatch):
    chooser = random.Random(5)
    filler = [f"filler{i}" for i in range(60)]
    texts = [f"{' '.join(chooser.choices(filler, k=8))} Zanzibar office jo@x.org {' '.join(chooser.choices(filler, k=8))}" for _ in range(5)]
    texts += [f"{i} " + " ".join(chooser.choices(filler, k=2000)) for i in range(200)]
    # A repeated row, a copy under another id, rows without an id, and rows without a text.
    rows = [*enumerate(texts), (0, texts[0]), (900, texts[0]), (None, texts[1]), (None, texts[1]), (901, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    frames = []

    def kept(df):
        frames.append(df)
        return checkpointed(df)

    monkeypatch.setattr(pii, "checkpointed", kept)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames.append(pii.find_personal_data(docs))
        got = Counted((row.doc_id, sorted({s.value for s in row.spans if s.kind == 4}) == ["office", "zanzibar"]) for row in frames[-1].collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == Counted((i, "jo@x.org" in (text or "")) for i, text in rows)
    # Each of the texts went through two joins before.
    assert sum(map(shuffled, frames)) < 0.5 * sum(map(len, texts))


def test_terms_of_a_long_text_take_time_in_proportion(spark):
    # 60,000 places of a term: each with neighbours of its own, so none of them is as another.
    texts = [" ".join(f"w{(i * i * (k + 3)) % 59_999}" for i in range(60_000)) + f" jo{k}@x.org me@y.org" for k in range(2)]
    start = time.perf_counter()
    assert pii.find_personal_data(docs_of(spark, texts), bits=0.0).count() == 2
    assert time.perf_counter() - start < 30


# --- spans ------------------------------------------------------------------------------------------------------------

#: The contract's base patterns of secrets and personal data, for Python's own matcher.
BASE = {
    "assign": (r"""((?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", lambda m: len(m[2]) >= 6),
    "access": (r"(AKIA[A-Z0-9]+)", lambda m: len(m[1]) >= 20),
    "hex": (r"([0-9a-f]+)", lambda m: len(m[1]) >= 24),
    "email": (r"([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+)", lambda m: True),
    "ip": (r"([0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+))", lambda m: all(int(x) <= 255 for x in m[1].split("."))),
    "card": (r"([0-9]([\x20-]?[0-9])+)", lambda m: 12 <= len(digits(m[1])) <= 19 and luhn(digits(m[1]))),
    "phone": (r"(\+[0-9][\x20().0-9-]+[0-9])", lambda m: 9 <= len(digits(m[1])) <= 15),
}


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text, kinds):
    found = []
    for k, kind in enumerate(kinds):
        pattern, keep = BASE[kind]
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if keep(m)]
    return ",".join(f"{kinds[k]}:{start}:{end}" for start, k, end in sorted(found))


def texts_with_spans(n):
    chooser = random.Random(11)
    parts = ["password: hunter22x", "TOKEN='ab.cd-ef'", "api_key=x", "AKIA" + "Q" * 18, "AKIAQ", "deadbeef" * 4, "abc", "me@x.org", "a@b..c", "a.b%c@d-e.co.uk",
             "10.0.0.255", "1.2.3.4.5", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-5678", "+1 2", "é日😀", "secret = \"zz", "plain"]
    texts = ["".join(chooser.choice(parts) + chooser.choice([" ", "", ",", "\n"]) for _ in range(chooser.randint(0, 40))) for _ in range(n)]
    return [*texts, *("".join(chooser.choices("+0123456789. -()@akAKI:=", k=200)) for _ in range(n)), None, ""]


def test_base_spans_equal_pythons_matcher(spark):
    texts = texts_with_spans(150)
    for module, find, kinds in ((secrets, secrets.find_secrets, secrets.KINDS[:3]), (pii, pii.find_personal_data, pii.KINDS[:4])):
        got = {row.doc_id: row for row in module.digest(find(docs_of(spark, texts))).collect()}
        for i, text in enumerate(texts):
            want = base_spans(text, kinds)
            assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (text, want)
            assert set(filter(None, want.split(","))) <= set(got[i].spans.split(","))


@pytest.mark.parametrize("block", [3, 256])
def test_spans_are_placed_and_cut_out_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(spans, "BLOCK", block)
    texts = [text or "" for text in texts_with_spans(30)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = F.expr("regexp_extract_all(text, '[0-9]+', 0)")
    numbers = spans.placed(F.col("text"), found, "[0-9]+", 1)
    wide = spans.placed(F.col("text"), F.expr("regexp_extract_all(text, '[0-9]..', 0)"), "[0-9]..", 0)
    both = spans.in_order(wide, numbers)
    made = rows.select("text", numbers.alias("n"), both.alias("both"), spans.redacted(F.col("text"), both, ["w", "n"]).alias("out"),
                       spans.uncovered(numbers, wide, 1).alias("free"), wide.alias("wide")).collect()
    for row in made:
        assert [(s.start, s.end, s.value) for s in row.n] == [(*m.span(), m[0]) for m in re.finditer("[0-9]+", row.text)]
        covered = {i for s in row.wide for i in range(s.start, s.end)}
        assert [s.start for s in row.free] == [s.start for s in row.n if not covered & set(range(s.start, s.end))]
        out, at = "", 0
        for s in row.both:
            if s.start >= at:
                out += row.text[at : s.start] + ("[W]" if s.kind == 0 else "[N]")
            at = max(at, s.end)
        assert row.out == out + row.text[at:]


def test_very_many_spans_of_one_text(spark):
    text = " ".join(f"4111 1111 1111 {i:04d}, {i}.0.0.1 word{i % 90}x" for i in range(12_000)) + " me@x.org"
    start = time.perf_counter()
    (row,) = pii.digest(pii.find_personal_data(docs_of(spark, [text]))).collect()
    assert row.base_sha256 == hashlib.sha256(base_spans(text, pii.KINDS[:4]).encode()).hexdigest()
    keys = " ".join(f"token={i:08d} {i}Zq{i * i}kVbX{i * 7919}hJ" for i in range(8_000))
    (row,) = secrets.digest(secrets.find_secrets(docs_of(spark, [keys]))).collect()
    assert row.base_sha256 == hashlib.sha256(base_spans(keys, secrets.KINDS[:3]).encode()).hexdigest()
    assert time.perf_counter() - start < 120


# --- fingerprints -----------------------------------------------------------------------------------------------------


def test_edits_follow_the_order_of_ids(spark, odd, empty):
    texts = [f"text {i} " + "word%d " % (i % 5) * (i % 11) for i in range(300)]
    got = {r.doc_id: r for r in simhash.with_edits(docs_of(spark, texts).repartition(5)).collect()}
    memo = hash_memo()
    for i, text in enumerate(texts):
        new = simhash.edited(text, texts[(i + 1) % 300])
        assert got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and got[i].n_chars == len(text)
        assert got[i].fingerprint == simhash.fingerprint(text, memo).hex()
    assert simhash.with_edits(odd).count() == odd.count() and simhash.with_edits(empty).count() == 0


def plain_fingerprint(text):
    """SimHash by the definition, with the library's hash of a word and of a pair, bit by bit."""
    words = (text or "").encode().lower().split()
    spread = lambda x: int(mixed(np.array([x % 2**64], np.uint64))[0])
    hashes = [xxhash.xxh64_intdigest(word) for word in words]
    terms = Counted(hashes), Counted((spread(a) + b) % 2**64 for a, b in zip(hashes, hashes[1:]))
    votes = [0.0] * 128
    for counts, share in zip(terms, (0.5, 1.0)):
        for term, count in counts.items():
            bits = spread(term ^ 0x5851F42D4C957F2D) << 64 | spread(term + 0x14057B7EF767814F)
            for k in range(128):
                votes[k] += share * (1 + math.log(count)) * (1 if bits >> (127 - k) & 1 else -1)
    return f"{sum((vote > 0) << (127 - k) for k, vote in enumerate(votes)):032x}", min(map(abs, votes), default=0)


def test_fingerprint_equals_the_plain_votes():
    chooser = random.Random(9)
    for _ in range(40):
        text = " ".join(chooser.choices(["alpha", "Beta", "c", "日本", "delta"], k=chooser.randint(0, 60)))
        plain, margin = plain_fingerprint(text)
        assert margin < 1e-4 or simhash.fingerprint(text, hash_memo()).hex() == plain


def test_edits_of_large_null_and_repeated_ids(spark):
    base = 2**60
    rows = [(base + 3 * i, f"large {i}") for i in range(1500)] + [(None, f"none {i}") for i in range(1000)] + [(5, f"same {i % 700}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    made = simhash.with_edits(docs).collect()
    assert len(made) == len(rows)
    got = {r.doc_id: r.edited_sha256 for r in made}
    for i in range(1499):
        assert got[base + 3 * i] == hashlib.sha256(simhash.edited(f"large {i}", f"large {i + 1}").encode()).hexdigest()
    last = {hashlib.sha256(simhash.edited("large 1499", f"none {i}").encode()).hexdigest() for i in range(1000)}
    assert got[base + 3 * 1499] in last


@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_hold_what_lies_between_their_starts(seed):
    chooser = np.random.default_rng(seed)
    pairs = sorted({(int(a), int(m)) for a, m in zip(chooser.integers(-3, 3, 60), chooser.integers(-9, 9, 60))})
    starts = pairs[::4]
    at, mark = (np.array(x, np.int64) for x in zip(*pairs))
    found = simhash.ranges_of(at, mark, *(np.array(x, np.int64) for x in zip(*starts)))
    assert found.tolist() == [sum(s <= p for s in starts) - 1 for p in pairs]


def test_neighbours_are_counted(spark):
    texts = ["a b c d e f g h"] * 5 + [f"other {i} text {i * i}" for i in range(60)] + [None]
    made = simhash.with_neighbours(simhash.with_edits(docs_of(spark, texts)), every=2).collect()
    prints = [int(row.fingerprint, 16) for row in made]
    assert len(made) == len(texts)
    for row in made:
        near = sum((int(row.fingerprint, 16) ^ p).bit_count() <= 3 for p in prints) - 1
        assert row.n_near == (near if row.doc_id % 2 == 0 else None)


def test_block_tables_find_all_neighbours(spark):
    chooser = random.Random(5)
    prints = [chooser.getrandbits(128) for _ in range(40)]
    prints += [p ^ sum(1 << chooser.randrange(128) for _ in range(chooser.randint(0, 5))) for p in prints for _ in range(4)]
    rows = [(i, f"{p:032x}") for i, p in enumerate(prints)]
    frame = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    got = {(r.query_id, r.doc_id, r.distance) for r in simhash.neighbours(frame.where("doc_id % 5 = 0"), frame, 3).collect()}
    want = {(i, j, d) for i, p in enumerate(prints) for j, q in enumerate(prints) if i % 5 == 0 and i != j and (d := (p ^ q).bit_count()) <= 3}
    assert got == want and want


# --- near-duplicates --------------------------------------------------------------------------------------------------


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, k, percent):
    chooser = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    texts = [None, "", "one two", "ONE two"]
    for _ in range(12):
        base = chooser.choices(words, k=chooser.randint(5, 120))
        for _ in range(12):
            copy = list(base)
            for _ in range(chooser.randint(0, 5)):
                copy[chooser.randrange(len(copy))] = chooser.choice(words)
            texts.append(" ".join(copy))
    sets = [shingles(t, k) for t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs_of(spark, texts), k, percent).collect()}
    assert got == {i: (len(s), label[i]) for i, s in enumerate(sets)}


def labels_by_matrix(texts, k, percent):
    """The least row that each row reaches over links, from all pairs of sets."""
    sets = [shingles(t, k) for t in texts]
    number = {x: i for i, x in enumerate(sorted(set().union(*sets)))}
    matrix = np.zeros((len(sets), len(number)), np.float32)
    for i, x in enumerate(sets):
        matrix[i, [number[y] for y in x]] = 1
    both, n = (matrix @ matrix.T).round().astype(np.int64), matrix.sum(axis=1).astype(np.int64)
    linked = both * 100 >= (n[:, None] + n[None, :] - both) * percent
    label = np.arange(len(sets))
    while True:
        new = np.where(linked, label[None, :], len(sets)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def near_threshold_texts(kind, n, seed):
    chooser = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    if kind == "sentences":  # many common sentences: similarities spread below and around the threshold
        lines = [" ".join(chooser.choices(words, k=8)) for _ in range(24)]
        return [" ".join(lines[i] for i in sorted(chooser.sample(range(24), chooser.choice([17, 17, 20, 22])))) for _ in range(n)]
    base, texts = chooser.choices(words, k=150), []
    for i in range(n):  # edits that others have too, at the threshold and beyond it
        copy = list(base) + (["the", "same", "end"] if i % 3 else [])
        for _ in range(chooser.choice([0, 2, 4, 5, 6, 7, 8])):
            at = chooser.randrange(len(copy) - 1)
            copy[at : at + 1] = chooser.choice([[], [copy[at], copy[at]], [words[at % 7]], [chooser.choice(words)]])
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("kind", ["sentences", "edits"])
def test_groups_around_the_threshold_equal_all_pairs(spark, monkeypatch, kind):
    made, across, n = [], hyperminhash._across, 1200
    monkeypatch.setattr(hyperminhash, "_across", lambda *given: made.append(checkpointed(across(*given))) or made[-1])
    texts = near_threshold_texts(kind, n, seed=n)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs_of(spark, texts), 3, 85).collect()}
    assert [got[i] for i in range(n)] == labels_by_matrix(texts, 3, 85).tolist()
    # Where edits coincide, or texts are mixes of the same sentences, a small share of all pairs is left (README).
    assert 0 < made[-1].count() < n * n / 2 * (0.1 if kind == "sentences" else 0.02)


def test_near_duplicates_on_odd_rows(odd, empty):
    assert near_duplicates(odd).count() == odd.count()
    kept = without_near_duplicates(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {None, *range(9)}
    assert near_duplicates(empty).count() == without_near_duplicates(empty).count() == 0
    assert (1 - 0.85**6) ** bands_for(85) <= 1e-6


def test_rows_without_or_with_one_id_are_told_apart(spark):
    a, b, c, d, e = (" ".join(f"{w}{i}" for i in range(40)) for w in "abcde")
    near = a.replace("a39", "other")
    # (id, text, kept): b has the id of a near copy of a; d is known by an id, e and c twice without one.
    rows = [(1, a, True), (7, near, False), (7, b, True), (7, b, False), (8, d, True), (None, d, False), (None, c, True), (None, c, False)]
    rows += [(None, e, True), (None, e.upper(), False), (None, "", True), (None, " ", True), (9, "", True), (9, None, True)]
    docs = spark.createDataFrame([(i, t, "s", "r", "p", 1) for i, t, _ in rows], DOCS)
    got = sorted(((r.doc_id, r.text and r.text.lower()) for r in without_near_duplicates(docs).collect()), key=str)
    assert got == sorted(((i, t and t.lower()) for i, t, stays in rows if stays), key=str)
    assert without_near_duplicates(docs).columns == docs.columns


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


# --- pages ------------------------------------------------------------------------------------------------------------


def test_main_text():
    page = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div>
    <div id="sidebar"><p>Side text, long long long</p></div><main><article><header><h1>Title</h1></header>
    <p>First paragraph of the story &amp; more,\n which is quite long.<div class="advert">Buy</div><p>Short.<ul><li>one<li>two</ul>
    <form><p>sign</form><p>Last <b>one</b> here.</p></article><section class="comments"><p>I disagree, and at length.</p></section>
    </main><footer>foot</footer><script>var t="</p>";</script></body></html>"""
    want = "Title First paragraph of the story & more, which is quite long. Short. one two Last one here."
    assert html_text.main_text(page) == want
    assert [html_text.main_text(x) for x in (None, "", "<p></p>", "just text", "<script>x")] == ["", "", "", "just text", ""]
    assert len(html_text.main_text("<div>x" * 20000)) > 30000


def test_main_text_keeps_all_clusters_and_looks_into_named_elements():
    words = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    lead, body, end = words(12, "lead"), words(120, "body"), words(10, "end")
    quote = f"<blockquote><p>{body}</p><p>{body}</p></blockquote>"
    # Clusters outside an element with 80% of their text.
    assert html_text.main_text(f"<div><div class=lead>{lead}</div><div class=body><p>{body}</p></div></div>") == f"{lead} {body}"
    assert html_text.main_text(f"<div><h1>Title</h1><p>{lead}</p>{quote}<p>{end}</p></div>") == f"Title {lead} {body} {body} {end}"
    assert html_text.main_text(f"<main><h1>Title</h1><p>by<p>me<p>now<article><p>{body}<p>{body}</article></main>").startswith("Title")
    # Elements named like no content that hold it: most of the text, or the article.
    for start, stop in (("<div class='with-sidebar'>", "</div>"), ("<form id=page>", "</form>"), ("<span class=share>", "</span>")):
        assert html_text.main_text(f"{start}<p>{body}</p>{stop}<p>tail</p>") == f"{body} tail"
    layout = f"<div id=search-page><article><p>{end}</p></article><div class=comments>{lead}</div></div><p>{lead}</p>"
    assert html_text.main_text(layout) == f"{end} {lead}"
    # Those that don't are still left out.
    assert html_text.main_text(f"<p>{body} <b class=advert>Buy</b></p><nav>{lead}</nav><div hidden>{body}</div>") == body
    assert html_text.main_text(f"<head><title>T</title><body><p>{body}") == body


def test_main_text_of_odd_shapes():
    words = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    short, long, longer = words(6, "short"), words(40, "long"), words(90, "longer")
    menu = "".join(f"<li><a href='/{i}'>Entry {i}</a></li>" for i in range(6))
    # A short article and a long footer; long comments below an article of one line, also as articles of their own.
    assert html_text.main_text(f"<body><article>{short}</article><footer>&copy; {long}</footer>") == short
    for start in ("<section class=comments>", "<div id='comment-list'>", "<article class=comment>"):
        tag = start[1:].split()[0]
        said = f"<article><p>{long}</article>" * 3 + f"<p>{longer}" * 2
        assert html_text.main_text(f"<article><p>{short}</p></article>{start}{said}</{tag}>") == short
        assert html_text.main_text(f"<article><p>{short}</p>{start}<p>{long}<p>{long}</{tag}></article>") == short
    # Words of classes inside an article.
    for name in ("related-work", "search-results", "share-price", "notice-board-history"):
        page = f"<article><p>{long}</p><section class='{name}'><p>{longer}</p></section><p>{short}</article>"
        assert html_text.main_text(page) == f"{long} {longer} {short}"
    assert html_text.main_text(f"<article><p>{longer}</p><div class='share-buttons'>{short}</div><p>{long}</article>") == f"{longer} {long}"
    # No names at all: a menu, a line on copyright, a text on cookies.
    page = f"<body><div class=x1><ul>{menu}</ul></div><div class=x2><h1>Title</h1><p>{long}<p>{longer}<p>{short}</div>"
    page += f"<div class=x3>&copy; 2024 {short}</div><div class=cc-window>We use cookies. {short}</div>"
    assert html_text.main_text(page) == f"Title {long} {longer} {short}"
    # A teaser beside main; a form around or inside it.
    assert html_text.main_text(f"<main><h1>T</h1><p>{long}</main><article><p>{longer}</article>") == f"T {long}"
    assert html_text.main_text(f"<form><main><p>{long}</main></form><form>{longer}</form>") == long
    assert html_text.main_text(f"<main><form><p>{long}<p>{longer}</form></main>") == f"{long} {longer}"


def test_main_text_of_all_test_pages():
    import duckdb

    own = re.compile(r"<article>(.*?)</article>", re.DOTALL)
    for page_id, html in duckdb.sql("SELECT page_id, html FROM '/root/testdata/sf0.1/pages.parquet'").fetchall():
        plain = re.sub(r"<[^>]*>", lambda tag: " " if tag[0].rstrip("/>")[1:].strip("/ ") in ("p", "br", "h1") else "", own.search(html)[1])
        assert html_text.main_text(html) == " ".join(unescape(plain).split()), page_id


def test_main_text_of_unclosed_markup_is_linear():
    start = time.perf_counter()
    for mark in ("<!--", "<div ", "<div", "</div"):
        assert html_text.main_text("<p>said</p>" + mark * 100_000) == "said"
    assert time.perf_counter() - start < 10
    assert html_text.main_text("<p>a &lt; b</p>1 < 2") == "a < b 1 < 2"


def test_extract_on_odd_rows(spark):
    rows = [(1, None, None, "t", 1), (2, "u", "", "t", 1), (None, "v", "<p>text &amp; more", "t", 1), (None, "v", "<p>text &amp; more", "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (2, "u", "", 0), (None, "v", "text & more", 11), (None, "v", "text & more", 11)], key=str)
    assert html_text.extract(pages.limit(0)).count() == 0


# --- decontamination --------------------------------------------------------------------------------------------------


def hits(words, items, window):
    """Brute force: hit positions and items."""
    where, which = set(), set()
    for item, run in items:
        size = min(window, len(run))
        runs = {tuple(run[i : i + size]) for i in range(len(run) - size + 1)} if run else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in runs:
                where |= set(range(i, i + size))
                which.add(item)
    return where, which


def test_automaton_equals_brute_force():
    chooser = random.Random(7)
    for _ in range(150):
        items = [(str(k), [chooser.choice([b"a", b"b", b"c"]) for _ in range(chooser.randint(0, 9))]) for k in range(6)]
        words = [chooser.choice([b"a", b"b", b"c", b"d"]) for _ in range(60)]
        spans, found = SuffixAutomaton(items, 4).scan(words)
        where, which = hits(words, items, 4)
        assert {p for a, z in zip(spans[::2], spans[1::2]) for p in range(a, z + 1)} == where and found == which


def test_decontamination_cuts_passages_only(spark, odd, empty):
    passage = "The quick brown fox jumps over the lazy dog and runs"
    items = spark.createDataFrame([(1, passage), (2, None), (3, "Short one!"), (3, "again")], "item_id long, text string")
    clean = " ".join(f"clean{i}" for i in range(30))
    docs = docs_of(spark, [clean, f"{clean}. {passage.upper()} - {clean}", passage, "É short ONE é " + clean])
    made = {r.doc_id: r.text for r in decontaminate(docs, items).collect()}
    assert made == {0: clean, 1: f"{clean}.  - {clean}", 3: "É  é " + clean}
    by_block = {r.row.doc_id: (r.n_hit, r.items) for r in contamination(docs, items, block_words=5).collect()}
    assert by_block == {r.row.doc_id: (r.n_hit, r.items) for r in contamination(docs, items).collect()}
    assert decontaminate(odd, items).columns == odd.columns and decontaminate(odd, items.limit(0)).count() == odd.count()
    assert decontaminate(empty, items).count() == 0 and words_of("É-a_B\x00c") == ["É".encode(), b"a", b"b", b"c"]


def test_kinds_of_words():
    assert not re.search("[A-Z]", b" ".join(words_of("ABC Ünder")).decode().replace("Ü", ""))


def test_python_workers_get_small_batches_with_each_text_once(spark):
    """A batch holds at most BATCH_ROWS rows, and the text only as a field of `row`; a size that the session has stays."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting, None)
    docs = spark.range(2500).selectExpr("id AS doc_id", "concat('w', id) AS text").coalesce(1)
    items = spark.createDataFrame([("i", "w7")], "item_id string, text string")
    try:
        spark.conf.unset(setting)
        found = contamination(docs, items)
        assert "text" not in found.columns and found.where("n_hit > 0").select("row.doc_id").collect() == [(7,)]
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
        assert [row.n for row in sizes] == [BATCH_ROWS, BATCH_ROWS, 500]
        spark.conf.set(setting, "700")
        contamination(docs, items)
        assert spark.conf.get(setting) == "700"
        model = toxicity.Model(0.0, {}, True)
        for plan in (contamination(docs, items), toxicity.scored(docs, model)):
            assert plan.select("row.text").count() == 2500
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
