"""Structure repair, prefix trie and sharding: brute force, SQL on odd rows, and plans."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from compare import differences, duck_rows, spark_rows

from fleetlens.llm import oracle, prefix_trie, sharding, structure_repair
from fleetlens.llm.prefix_trie import ZFastTrie, prefix_hashes, two_fattest
from fleetlens.llm.structure_repair import _EDITS, _NEXT, cheapest, roles_of

TURNS = "conv_id long, turn long, role string, text string, digest string, leads int, size int"


def turns_of(spark, rows):
    """Turns with columns named as some that the operators make."""
    return spark.createDataFrame([(*row, "d", 7, 1) for row in rows], TURNS)


def odd_conversations(seed: int, n: int = 60):
    """Nulls in every column, repeated rows, missing turns, unknown roles, empty and long texts."""
    r = random.Random(seed)
    texts = ["Yes.", "No", "", " ", None, "\t\n", "Well?", "é 日本!", "Go on. ", "a" * 3000, "Well?"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User", "é"]
    rows = []
    for conv in [None, *range(n)]:
        turn = 0
        for _ in range(r.choice([1, 2, 5, 12, 30])):
            turn += r.choice([1, 1, 1, 2])
            row = (conv, None if r.random() < 0.1 else turn, r.choice(roles), r.choice(texts))
            rows += [row] * r.choice([1, 1, 1, 2])
    return rows


def in_sql(spark, turns, query):
    connection = duckdb.connect()
    rows = turns.select("conv_id", "turn", "role", "text").toArrow()  # noqa: F841 (read by name)
    connection.execute("CREATE TABLE conversations AS SELECT * FROM rows")
    return duck_rows(connection, query)


# --- structure repair -------------------------------------------------------------------------------------------------


def best_by_layers(signs: str) -> tuple[int, str]:
    """All states row by row, whole audits; insertions are closed over before each row."""

    def closed(best):
        for _ in range(4):
            for q, (cost, audit) in list(best.items()):
                best[_NEXT[q]] = min(best.get(_NEXT[q], (10**9, "")), (cost + 2, audit + "I"))
        return best

    best = closed({0: (0, "")})
    for sign in signs:
        new = {}
        for q, letter, cost, to in _EDITS[sign]:
            if q in best:
                new[to] = min(new.get(to, (10**9, "")), (best[q][0] + cost, best[q][1] + letter))
        best = closed(new)
    return min(best[q] for q in (0, 3) if q in best)


def test_search_equals_layers():
    for n in range(5):
        for signs in map("".join, itertools.product("-suaxSUA", repeat=n)):
            assert cheapest(signs) == best_by_layers(signs), signs
    r = random.Random(5)
    for _ in range(200):
        signs = "".join(r.choices("-suaxSUAX", k=r.randint(5, 150)))
        assert cheapest(signs) == best_by_layers(signs), signs


def test_search_of_a_long_conversation_is_linear():
    signs = "".join(random.Random(1).choices("-suaxSUAX", k=50_000))
    cost, audit = cheapest(signs)
    assert 0 < cost <= 3 * len(signs) and len(audit) - audit.count("I") == len(signs)


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_sql_on_odd_rows(spark, seed):
    turns = turns_of(spark, odd_conversations(seed))
    found = structure_repair.report(structure_repair.damaged(turns), ids=turns)
    assert differences(spark_rows(found), in_sql(spark, turns, oracle.REPAIR)) == ""


def test_repaired_rows_are_legal(spark):
    turns = turns_of(spark, odd_conversations(3))
    conversations = defaultdict(list)
    for row in structure_repair.repair(turns).collect():
        conversations[row["conv_id"]].append(row)
    for rows in conversations.values():
        rows.sort(key=lambda row: row["place"])
        assert [row["place"] for row in rows] == list(range(len(rows)))
        initials = "".join(row["role"][0] for row in rows)
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2) and len(initials) != 1
    assert roles_of("DKIK") == [None, "user", "assistant"] and roles_of("D") == []


def test_repair_without_rows(spark):
    none = turns_of(spark, [])
    assert structure_repair.report(none, ids=none).count() == 0 and structure_repair.repair(none).count() == 0
    dropped = turns_of(spark, [(1, 0, "user", "Hi.")])
    found = structure_repair.report(dropped.limit(0), ids=dropped).first()
    assert tuple(found)[:8] == (1, 0, 0, 0, 0, 0, 0, "")


# --- prefix trie ------------------------------------------------------------------------------------------------------


def test_two_fattest_numbers():
    for low, high in itertools.combinations(range(70), 2):
        assert two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda x: (x & -x))


@pytest.mark.parametrize("seed", range(6))
def test_trie_equals_a_dictionary_of_prefixes(seed):
    r = random.Random(seed)
    words = [bytes([k]) * 16 for k in range(3)]
    chains = [[r.choice(words) for _ in range(r.choice([0, 1, 2, 5, 20, 60]))] for _ in range(150)]
    chains += [chain[: r.randint(0, len(chain))] + [words[0]] * r.randint(0, 3) for chain in chains]
    trie, members, ends = ZFastTrie(), defaultdict(list), defaultdict(int)
    items = []
    for name, chain in enumerate(chains):
        path = prefix_hashes(chain)
        items.append((path, [1] * len(chain), name))
        ends[path[-1]] += 1
        for depth, prefix in enumerate(path):
            members[prefix, depth].append(name)
    r.shuffle(items)
    for i in range(0, len(items), 37):
        trie.insert(items[i : i + 37])
    made = {(row[0], row[2]): row[3:5] for row in trie.expanded()}
    assert made == {key: (len(names), min(names)) for key, names in members.items()}
    # Compacted: a node ends a conversation or parts paths; each is found by its handle, and its edges by their exit nodes.
    for node in trie.nodes():
        assert node.ends or len(node.children) > 1 or node is trie.root
        assert node is trie.root or trie.handles[node.handle] is node
        for depth in range(node.low + 1, node.high + 1):
            assert trie.exit_node(node.path[: depth + 1]) is node
    assert len(trie.handles) == len(trie.nodes()) - 1


@pytest.mark.parametrize(("seed", "trie_turns"), [(1, 10), (2, 400_000)])
def test_nodes_equal_sql_on_odd_rows(spark, seed, trie_turns):
    turns = turns_of(spark, odd_conversations(seed))
    rows = prefix_trie.crossed(prefix_trie.turn_rows(turns))
    assert differences(spark_rows(prefix_trie.prefix_nodes(rows, trie_turns)), in_sql(spark, turns, oracle.PREFIXES)) == ""


def test_one_conversation_told_by_very_many(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(9000) for t in range(2)]
    rows += [(9001, 0, "user", "turn 0"), (-7, None, None, None)]
    walked = prefix_trie.turn_rows(turns_of(spark, rows))
    found = {(r["conv_id"], r["depth"]): r for r in prefix_trie.prefix_nodes(walked).collect()}
    assert set(found) == {(-7, 0), (-7, 1), (0, 1), (0, 2)}
    assert found[0, 1]["n_convs"] == 9001 and found[0, 2]["n_convs"] == 9000 and found[-7, 0]["n_leaves"] == 2
    assert found[0, 1]["saved_tokens"] == 9000 * 6 + 8999 * 6 and found[-7, 0]["saved_tokens"] == found[0, 1]["saved_tokens"]
    assert found[0, 2]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(9000))).encode()).hexdigest()
    assert prefix_trie.prefix_nodes(walked.limit(0)).count() == 0


# --- sharding ---------------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, shard string, size string, digest string"


def test_longest_first_equals_the_plain_rule():
    r = random.Random(3)
    for _ in range(50):
        items = [(r.choice([1, 2, 5, r.randint(1, 1000)]), f"{k:03}") for k in range(r.randint(0, 60))]
        loads, expected = [0] * 5, {}
        for weight, key in sorted(items, key=lambda item: (-item[0], item[1])):
            shard = loads.index(min(loads))
            loads[shard] += weight
            expected[key] = shard
        assert sharding.longest_first(items, 5) == expected


@pytest.mark.parametrize("items_per_shard", [1, 64, 1024])
def test_shards(spark, items_per_shard):
    r = random.Random(4)
    rows = [(i, r.choice(["", None, "é" * 40, f"own {i} " * r.randint(1, 60)]), "s", "z", "d") for i in range(800)]
    rows += [(7, "one", "s", "z", "d")] * 300 + [(None, f"n{i % 3}", "s", "z", "d") for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    found = sharding.assign(docs, 4, items_per_shard).collect()
    assert len(found) == len(rows)
    loads, slots, shard_of = [0] * 4, defaultdict(list), {}
    texts = {sharding_digest(row[1]): row[1] or "" for row in rows}
    for row in found:
        text = texts[row["digest"]]
        assert row["size"] == len(text.encode()) + 1 and row["text_crc32"] == zlib.crc32(text.encode())
        assert shard_of.setdefault(text, row["shard"]) == row["shard"]
        loads[row["shard"]] += row["size"]
        slots[row["shard"]].append((row["slot"], row["doc_id"] is not None, row["doc_id"] or 0, row["digest"]))
    for rows_of in slots.values():
        rows_of.sort()
        assert [row[0] for row in rows_of] == list(range(len(rows_of)))
        assert [row[1:] for row in rows_of] == sorted(row[1:] for row in rows_of)
    if items_per_shard > 1:
        assert max(loads) - min(loads) < sum(loads) / 4 * 0.1
    if items_per_shard == 1024:  # every group is an item of its own
        weights = defaultdict(int)
        for row in rows:
            weights[sharding_digest(row[1])] += len((row[1] or "").encode()) + 1
        placed = sharding.longest_first([(w, k) for k, w in weights.items()], 4)
        large = {k for k, w in weights.items() if w * 4096 >= sum(weights.values())}
        assert all(placed[row["digest"]] == row["shard"] for row in found if len(large) == len(weights))


def sharding_digest(text):
    return hashlib.md5((text or "").encode()).hexdigest()


def test_shards_of_no_documents_and_files(spark, tmp_path):
    none = spark.createDataFrame([], DOCS)
    assert sharding.digest(sharding.assign(none)).count() == 0
    docs = spark.createDataFrame([(i, f"text {i % 9}") for i in range(50)], "doc_id long, text string")
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.select("doc_id", "text").collect()) == sorted(docs.collect())
    expected = {(row["doc_id"], row["shard"]) for row in sharding.assign(docs, 3).collect()}
    assert {(row["doc_id"], row["shard"]) for row in back.collect()} == expected
    with pytest.raises(ValueError):
        sharding.write_shards(none, str(tmp_path / "no"))
