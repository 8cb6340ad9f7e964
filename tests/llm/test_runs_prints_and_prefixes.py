"""Periodic runs, winnowed fingerprints and the prefix trie against brute force, on ordinary rows and on odd tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from garimpo.llm import prefix_trie, queries, tandem_runs, winnowing
from workload.check import compare, connect, normal

EXTRA = "size int, hash string, block int, words string, runs string, head int, root long, pos string"
CLASH = (1, "x", 2, "y", "z", 3, 4, "p")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def write(spark, tmp_path, name, rows, schema):
    spark.createDataFrame([(*r, *CLASH) for r in rows], f"{schema}, {EXTRA}").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def periodic(rng, letters):
    words = []
    while len(words) < rng.randrange(0, 160):
        if rng.random() < 0.4:
            unit = [rng.choice(letters) for _ in range(rng.randrange(1, 7))]
            words += (unit * rng.randrange(2, 9))[: rng.randrange(1, 60)]
        else:
            words.append(rng.choice(letters))
    return words


def documents(kind):
    rng = random.Random(11)
    ordinary = [(i, " ".join(periodic(rng, "abcdefgh"[: rng.randrange(1, 8)]))) for i in range(120)]
    ordinary += [(500 + i, ordinary[i // 2][1]) for i in range(20)]
    odd = [
        (1000, None),
        (1001, ""),
        (1002, " \t\r\n\x0b\x0c "),
        (None, "a b a b a b a b a b"),
        (None, None),
        (None, "río 日本 río 日本"),
        *[(1003, "same row of words " * 6)] * 5,
        *[(1003, "other text of this id")] * 2,
        (-7, "x" * 40_000),
        (1004, "ab " * 30_000),
        (1005, "é日 本 語 " * 3000),
        (1006, " not white  " * 9),
    ]
    return {"ordinary": ordinary, "odd": odd, "one": [(3, "only one row")], "empty": [], "equal": [(4, "again " * 9)] * 60}[kind]


KINDS = ["ordinary", "odd", "one", "empty", "equal"]


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def plain_runs(words):
    """Every stretch for every period, by definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            smaller = any(all(words[j] == words[j + p] for j in range(start, end - p)) for p in range(1, q))
            if end - start >= max(6, 4 * q) and not smaller:
                out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(300):
        texts = [[w.encode() for w in periodic(rng, "abcde"[: rng.randrange(1, 6)])] for _ in range(rng.randrange(1, 6))]
        assert tandem_runs.of_texts(texts) == [plain_runs(t) for t in texts]


def test_runs_in_small_parts(monkeypatch):
    """The bounds on what is held at once change nothing, nor does a text longer than they are."""
    rng = random.Random(2)
    texts = [[w.encode() for w in periodic(rng, "abc")] for _ in range(40)]
    plain = tandem_runs.of_texts(texts)
    monkeypatch.setattr(tandem_runs, "TESTED", 7)
    assert tandem_runs.of_texts(texts) == plain


def test_suffix_array_is_sorted_with_its_common_prefixes():
    import numpy as np

    rng = random.Random(3)
    for n in (1, 2, 50, 400):
        text = [rng.randrange(2) for _ in range(n)]
        array = tandem_runs.suffix_array(np.array(text))
        assert array.order.tolist() == sorted(range(n), key=lambda i: text[i:])
        for k in range(1, n):
            a, b = text[array.order[k - 1] :], text[array.order[k] :]
            assert array.shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_long_chains_of_common_prefixes():
    """Interval bounds that pointers reach only in many jumps."""
    words = [b"a"] * 3000 + [b"b"] + [b"a"] * 1500 + [b"a", b"c"] * 700
    assert tandem_runs.of_texts([words])[0] == [(0, 3000, 1), (3001, 1501, 1), (4501, 1400, 2)]


def expected_runs(doc_id, text):
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words) if n < 2000 else [tuple(r) for r in tandem_runs.of_texts([[w.encode() for w in words]])[0]]
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = best[1] and 1000 * best[1] // best[2]
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *best, milli, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


@pytest.mark.parametrize("kind", KINDS)
def test_op11_on_tables(spark, tmp_path, kind):
    rows = documents(kind)
    if kind == "ordinary":  # ids whose texts get a periodic end
        rows = rows + [(i, rows[i % 100][1]) for i in range(2000, 4000) if zlib.crc32(str(i).encode()) % 10 == 0]
    df = queries.op11_tandem_runs(spark, write(spark, tmp_path, "documents", rows, "doc_id long, text string"))
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in df.dtypes[1:6]} == {"bigint"}
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(expected_runs(*r)) for r in rows)


def test_op11_on_driver_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_tandem_runs(spark, sf_dir).collect()
    short = {r["doc_id"]: r["text"] for r in rows if len(words_of(r["text"])) < 700}
    assert len(got) == len(rows) and len(short) > 50
    for r in got:
        if r["doc_id"] in short:
            assert tuple(r) == expected_runs(r["doc_id"], short[r["doc_id"]])


def plain_prints(text, gram, window):
    if not text:
        return []
    gram = min(gram, len(text))
    hashes = []
    for i in range(len(text) - gram + 1):
        x = 0
        for c in text[i : i + gram]:
            x = (x * winnowing.BASE + c + 1) % 2**64
        x ^= x >> 29
        hashes.append((x * 0xBF58476D1CE4E5B9 % 2**64) >> 24)
    window = min(window, len(hashes))
    chosen = set()
    for i in range(len(hashes) - window + 1):
        least = min(hashes[i : i + window])
        chosen.add(max(j for j in range(i, i + window) if hashes[j] == least))
    return [(p, hashes[p]) for p in sorted(chosen)]


def plain_likeness(a, b):
    x, y = (Counter(h for _, h in f) for f in (a, b))
    return sum((x & y).values()) / sum((x | y).values()) if x or y else 1.0


def test_winnowing_is_the_plain_rule(monkeypatch):
    rng = random.Random(4)
    for at_once in (1 << 22, 33):
        monkeypatch.setattr(winnowing, "AT_ONCE", at_once)
        for _ in range(150):
            text = bytes(rng.choice(b"ab c") for _ in range(rng.randrange(0, 200)))
            gram, window = rng.choice([(24, 40), (5, 7), (1, 1), (8, 16), (3, 2)])
            got = winnowing.winnow(text, gram, window)
            assert list(zip(got.places.tolist(), got.hashes.tolist(), strict=True)) == plain_prints(text, gram, window)


def test_shared_passages_share_a_mark():
    """The guarantee: GRAM + WINDOW - 1 equal bytes give a common hash; fewer than GRAM none."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz "

    def noise(n):
        return "".join(rng.choice(letters) for _ in range(n)).encode()

    for _ in range(200):
        passage = noise(winnowing.GRAM + winnowing.WINDOW - 1)
        a, b = (winnowing.winnow(noise(rng.randrange(300)) + passage + noise(rng.randrange(300))) for _ in range(2))
        assert set(a.hashes.tolist()) & set(b.hashes.tolist())
        short = noise(winnowing.GRAM - 1)
        a, b = (winnowing.winnow(noise(200) + x + short + x + noise(200)) for x in (b"#", b"+"))
        assert winnowing.likeness(a, b) == 0


def expected_prints(rows):
    """The order with nulls last, descending; rows of one id in descending order of the text's hash."""
    out = []
    for i, (doc_id, _, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][2]
        cut = len(text) // 3
        changed = text[: len(text) - cut] + after[:cut]
        own, marks, next_ = (plain_prints(t.encode(), winnowing.GRAM, winnowing.WINDOW) for t in (text, changed, after))
        prints = ["".join(f"{h:010x}" for _, h in f) for f in (own, marks)]
        out.append((doc_id, len(text), sha(changed), *prints, plain_likeness(own, marks), plain_likeness(own, next_)))
    return sorted(map(repr, out))


@pytest.mark.parametrize("kind", KINDS)
def test_op12_on_tables(spark, tmp_path, kind):
    sf_dir = write(spark, tmp_path, "documents", documents(kind), "doc_id long, text string")
    text = F.coalesce("text", F.lit(""))
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.xxhash64(text), text).collect()
    rows = sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    df = queries.op12_winnowing(spark, sf_dir)
    assert sorted(map(repr, map(tuple, df.collect()))) == expected_prints(rows)


def test_op12_on_driver_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy(F.desc("doc_id")).collect()
    got = {r["doc_id"]: r for r in queries.op12_winnowing(spark, sf_dir).collect()}
    for i, r in enumerate(rows):
        after = rows[(i + 1) % len(rows)]
        changed = winnowing.edited(r["text"], after["text"])
        g = got[r["doc_id"]]
        assert (g["n_chars"], g["edited_sha256"]) == (len(r["text"]), sha(changed))
        own, marks, next_ = (winnowing.winnow(t.encode()) for t in (r["text"], changed, after["text"]))
        assert (g["fingerprint"], g["edited_fingerprint"]) == (own.hex(), marks.hex())
        assert (g["near_edited"], g["near_next"]) == (winnowing.likeness(own, marks), winnowing.likeness(own, next_))


def test_marks_keep_places(spark):
    docs = spark.createDataFrame([(1, "some words " * 30), (2, None), (None, "short")], "doc_id long, text string")
    for r in winnowing.fingerprints(docs).collect():
        text = {1: "some words " * 30, 2: "", None: "short"}[r["doc_id"]].encode()
        assert [tuple(m) for m in r["marks"]] == plain_prints(text, winnowing.GRAM, winnowing.WINDOW)


def conversations(kind):
    rng = random.Random(6)
    lines = ["hi", "hello there", "é日", "", "what?"]

    def talk(c, n):
        return [(c, t, rng.choice(["user", "bot"]), rng.choice(lines)) for t in range(n)]

    ordinary = [t for c in rng.sample(range(1000), 150) for t in talk(c, rng.randrange(1, 9))]
    odd = [
        *[(None, i, "user", "lost") for i in range(5)],
        (100, None, "user", "first"),
        (100, None, None, "first"),
        (100, 0, "user", None),
        *[(100, 1, "user", "tie")] * 3,
        (101, -5, None, None),
        (102, 7, "user", "alone"),
        *[(205, 0, "user", "no root here")] * 2,
        *[(c, t, "user", f"chain {t}") for c in (300, 301, 302) for t in range(40)],
        *[(303, t, "user", f"long {t % 3}") for t in range(2500)],
        (-150, 1, "user", "below zero"),
        (7_000_000_000, 1, "user", "x" * 5000),
    ]
    few = [(c, 0, "user", "x") for c in range(6)]
    return {"ordinary": ordinary, "odd": odd, "few": few, "one": [(5, 0, "user", "x")], "empty": [], "equal": [(9, 3, "a", "b")] * 50}[kind]


def expected_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    # Ties of a number go by a hash; these tables tie on equal turns alone.
    members, ends, size = defaultdict(list), defaultdict(list), {}
    for c in own:
        own[c].sort(key=lambda t: (t[0], t[1]))
    sequences = {}
    for c, turns in own.items():
        head = zlib.crc32(str(c).encode()) % 6
        root = c - (c % 100 if c >= 0 else -(-c % 100))
        sequences[c] = [t[2:] for t in own.get(root, [])[:head]] + [t[2:] for t in turns[head:]]
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
            size[tuple(s[:d])] = len(s[d - 1][1]) if d else 0
        ends[tuple(s)].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) or 1
        saved[path] = (len(members[path]) - 1) * size[path] + sum(saved[k] for k in children[path])
    return sorted(
        repr((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
            sha(",".join(map(str, sorted(ends.get(p, []))))),
        ))
        for p, m in members.items()
    )


@pytest.mark.parametrize("kind", ["ordinary", "odd", "few", "one", "empty", "equal"])
def test_op13_on_tables(spark, tmp_path, kind, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLICE", 64)
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", 1)
    rows = [r for r in conversations(kind) if r[:2] != (100, None) or r[2]]
    sf_dir = write(spark, tmp_path, "conversations", rows, "conv_id long, turn long, role string, text string")
    df = queries.op13_prefix_trie(spark, sf_dir)
    assert sorted(map(repr, map(tuple, df.collect()))) == expected_trie(rows)
    result = connect_to(sf_dir).execute(prefix_trie.SQL)
    assert compare(normal(df.columns, df.collect()), normal([d[0] for d in result.description], result.fetchall())) is None


def connect_to(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM '{sf_dir}/conversations.parquet/*.parquet'")
    return con


def test_turns_of_one_number_have_one_order(spark):
    rows = conversations("odd")
    frames = [spark.createDataFrame(r, "conv_id long, turn long, role string, text string") for r in (rows, rows[::-1])]
    a, b = (sorted(map(tuple, prefix_trie.ordered_turns(f).collect())) for f in frames)
    assert a == b and len(a) == len(rows) - 5


def test_op13_on_driver_conversations(spark):
    sf_dir = "/root/testdata/sf0.01"
    df = queries.op13_prefix_trie(spark, sf_dir)
    result = connect(sf_dir).execute(prefix_trie.SQL)
    assert compare(normal(df.columns, df.collect()), normal([d[0] for d in result.description], result.fetchall())) is None
