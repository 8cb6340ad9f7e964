"""Operators on documents against brute force: ordinary texts, and tables with nulls, ties, copies, long texts and odd columns."""

import hashlib
import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from garimpo.llm import bpe, class_lm, language, mixing, sharding, simhash, suffix_dedup
from garimpo.llm.common import LOWER, components, kept

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, _key string, size int, shard string, node long, _row int, _spans int"
)
EXTRA = ("k", 1, "s", 2, 3, 4)
WORDS = {"en": "the of and river stone over under light", "fr": "le la été où forêt pierre sur lumière", "de": "der die über straße wälder stein licht"}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", "", "s", "ing"]) for _ in range(n))


def ordinary(n=150):
    rng = random.Random(5)
    passage = prose(rng, "en", 90)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        text = prose(rng, lang, rng.randrange(5, 160))
        if i % 7 == 0:
            text = f"{text} {passage} {prose(rng, lang, 10)}"
        if i % 10 == 9:
            text = rows[-1][1] + (" End." if i % 20 == 9 else "")
        rows.append((i, text, lang, rng.choice(["a", "b", "ü", None]), len(text)))
    return rows


ODD = [
    (1000, None, None, None, None),
    (1001, "", "en", "a", 0),
    (1002, " \t\n ", None, "", 4),
    (None, "the river over the stone", "en", None, 24),
    (None, None, None, "a", None),
    (1003, "12 34 !!", "en", "b", 8),
    *[(1004, "same row the of and", "en", "a", 19)] * 3,
    (1005, "x" * 30_000, None, "b", 30_000),
    (1006, "é日本 " * 4000, "fr", None, 16_000),
    (1007, "ab" * 150, "de", "a", 300),
    (1008, "<|endoftext|> the THE The", "en", "b", 25),
]
TABLES = {"ordinary": ordinary(), "odd": ODD, "both": [*ordinary(40), *ODD], "empty": []}


@pytest.fixture(params=TABLES, scope="module")
def table(request, spark):
    rows = TABLES[request.param]
    return rows, spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)


def ordered(rows):
    return sorted(rows, key=repr)


def test_shards_are_whole_gapless_and_even(table):
    rows, docs = table
    got = sharding.lpt_shards(docs, 6).collect()
    size = {t: (len(t.encode()) if t is not None else 0) + 8 for _, t, *_ in rows}
    crc = {t: zlib.crc32(t.encode()) if t is not None else None for t in size}
    assert ordered((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == ordered((d, size[t], crc[t]) for d, t, *_ in rows)
    for shard in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    homes = {}
    for r in got:
        homes.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    if rows:
        groups = Counter()
        for _, t, *_ in rows:
            groups[t] += size[t]
        loads = [sum(r["size"] for r in got if r["shard"] == s) for s in range(6)]
        # The bound of the longest-processing-time rule.
        assert max(loads) <= max((4 / 3) * sum(loads) / 6 + 1, max(groups.values()))


def test_schedule_is_the_plain_rule_on_equal_groups():
    from pyspark.sql import Row

    plan = sharding.schedule([Row(**{"class": 9, "n": 5, "bytes": 50}), Row(**{"class": 3, "n": 7, "bytes": 21})], 3)
    loads = [0, 0, 0]
    for size, (_, ends, shards) in zip((10, 3), plan, strict=True):
        for n, s in zip(np.diff([0, *ends]), shards, strict=True):
            loads[s] += int(n) * size
    assert sum(loads) == 71 and max(loads) - min(loads) <= 3


def test_mix_meets_budgets_and_agrees_with_itself(table):
    rows, docs = table
    got = mixing.mix(docs).drop("_key").collect()
    words = [len((t or "").encode().split()) for _, t, *_ in rows]
    assert ordered((r["doc_id"], r["source"], r["size"]) for r in got) == ordered((r[0], r[3], w) for r, w in zip(rows, words, strict=True))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(w for r, w in zip(rows, words, strict=True) if r[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    open_, target, left = set(sources), {}, 1.5 * sum(sizes.values())
    while open_:  # share, stop those above, share the rest again
        part = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if part[s] > 2 * sizes[s]}
        if not above:
            target |= part
            break
        target |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2 * sizes[s] for s in above)
        open_ -= above
    for s in sources:
        mine = [r for r in got if r["source"] == s]
        assert mine[0]["target"] == pytest.approx(target[s]) and abs(sum(r["taken"] for r in mine) - target[s]) <= 0.5
    assert ordered(map(tuple, got)) == ordered(map(tuple, mixing.mix(docs.repartition(5)).drop("_key").collect()))


def test_mixed_texts_repeat_whole_documents(table):
    rows, docs = table
    taken = mixing.mix(docs).collect()
    texts = mixing.mixed_texts(docs)
    assert texts.columns == docs.columns
    out = texts.collect()
    assert sum(len(r["text"].encode().split()) for r in out) == sum(r["taken"] for r in taken)
    assert len(out) == sum(-(-r["taken"] // r["size"]) for r in taken if r["size"])
    assert sum(r["text"] not in {t for _, t, *_ in rows} for r in out) <= len({r["source"] for r in taken})


@pytest.fixture(scope="module")
def encoding():
    ranks = bpe.load_ranks(None, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library_and_decode_to_the_text(table, encoding):
    rows, docs = table
    got = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True).collect()
    expected = [(d, encoding[1].encode_ordinary(t or ""), (t or "").encode()) for d, t, *_ in rows]
    assert ordered((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got) == ordered(expected)
    for r in got:
        raw = np.array(r["ids"], "<u4").tobytes()
        assert r["n_tokens"] == len(r["ids"]) and r["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(bytes(r["decoded"])).hexdigest()


def test_long_pieces_merge_like_the_library(encoding):
    ranks, known = encoding
    rng = random.Random(1)
    for alphabet, n in (("a", 700), ("ab", 3000), ("aeinrst", 5000), ("xyz0", 900), ("é日", 400)):
        piece = "".join(rng.choice(alphabet) for _ in range(n))
        assert bpe.merge(piece.encode(), ranks) == known._encode_single_piece(piece.encode())
        assert bpe.decode(bpe.merge(piece.encode(), ranks), ranks) == piece.encode()


def test_short_pieces_merge_like_the_library_and_read_no_stale_pair(encoding):
    """The merge of "ab" breaks up "bc", whose bucket is then left unread, as no pair is left."""
    ranks, known = encoding
    rng = random.Random(2)
    for _ in range(3000):
        piece = "".join(rng.choice("aeiorstnl é") for _ in range(rng.randrange(1, 14))).encode()
        assert bpe.merge(piece, ranks) == known._encode_single_piece(piece)

    popped = []
    sys.setprofile(lambda frame, event, called: event == "c_call" and called.__name__ == "pop" and popped.append(1))
    try:
        assert bpe.merge(b"abc", {b"a": 0, b"b": 1, b"c": 2, b"ab": 3, b"bc": 4}) == [3, 2]
    finally:
        sys.setprofile(None)
    assert len(popped) == 1


def by_the_rule(piece, ranks):
    """The lowest rank first, the leftmost of its pairs first, one merge at a time."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks), default=None)
        if found is None:
            return [ranks[p] for p in parts]
        parts[found[1] : found[1] + 2] = [b"".join(parts[found[1] : found[1] + 2])]


@pytest.mark.parametrize("many", [1, 3, 10**9])
def test_pieces_merged_together_are_merged_as_if_alone(monkeypatch, many):
    """Vocabularies in any order, so pairs of a lower rank come up, and pieces full of pairs that share a token."""
    monkeypatch.setattr(bpe, "MANY", many)
    rng = random.Random(4)
    for _ in range(60):
        tokens = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 5))) for _ in range(rng.randrange(1, 30))})
        rng.shuffle(tokens)
        ranks = {token: rank for rank, token in enumerate([*(bytes([b]) for b in range(256)), *tokens])}
        pieces = [bytes(rng.choice(rng.choice([b"a", b"ab", b"abcd"])) for _ in range(rng.randrange(0, 15))) for _ in range(60)]
        got = bpe.merge_all(pieces, ranks, bpe.Pairs(ranks))
        assert [list(np.frombuffer(ids, "<u4")) for ids in got] == [by_the_rule(p, ranks) for p in pieces]


def test_new_pieces_of_texts_share_a_queue_and_bounds_change_no_result(encoding, monkeypatch):
    ranks, known = encoding
    rng = random.Random(6)
    texts = ["", *[" ".join("".join(rng.choice("aeiorstnl7é") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(80))) for _ in range(60)]]
    texts += ["x" * 300, texts[5], "", " ".join(texts)]
    wanted = [known.encode_ordinary(t) for t in texts]
    calls = []
    merged = bpe.merge_all
    monkeypatch.setattr(bpe, "merge_all", lambda pieces, *more: calls.append(len(pieces)) or merged(pieces, *more))
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    assert [list(np.frombuffer(ids, "<u4")) for ids in encoder.encode(texts)] == wanted
    assert len(calls) == 2 and max(calls) > 1000  # the new pieces together, and the one that is too long to keep
    for met, kept_bytes, merged_bytes in ((50, 20_000, 100), (1, 1, 1), (700, 100_000, 1 << 18)):
        for name, value in (("MET", met), ("KEPT_BYTES", kept_bytes), ("MERGED_BYTES", merged_bytes)):
            monkeypatch.setattr(bpe, name, value)
        encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
        assert [list(np.frombuffer(ids, "<u4")) for ids in encoder.encode(texts)] == wanted
        assert encoder.held <= kept_bytes // 2 + met * 500


def test_what_a_worker_keeps_serves_the_tasks_of_its_name_alone():
    first = kept("one", list)
    assert kept("one", list) is first and kept("one") is first
    second = kept("two", list)
    assert second is not first and kept("one", list) is not first
    assert kept(None) is None and kept("one") is None


def plain_fingerprint(text):
    words = (text or "").encode().translate(LOWER).split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(ids, prints):
    """A group for each row, and the lowest known id of each group."""
    top = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                old, new = top[i], top[j]
                top = [new if x == old else x for x in top]
    lowest = {}
    for d, g in zip(ids, top, strict=True):
        lowest[g] = min((x for x in (lowest.get(g), d) if x is not None), default=None)
    return top, lowest


def test_fingerprints_and_groups(table):
    rows, docs = table
    got = simhash.near_duplicates(docs).collect()
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    top, lowest = plain_groups([r[0] for r in rows], prints)
    expected = [(r[0], f"{p:016x}", lowest[g]) for r, p, g in zip(rows, prints, top, strict=True)]
    assert ordered(map(tuple, got)) == ordered(expected)


def test_every_link_within_the_radius_is_found(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(6):
            for bit in rng.sample(range(64), rng.randrange(1, 6)):
                p ^= 1 << bit
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    groups = {r["node"]: r["component"] for r in components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))).collect()}
    for p in signed:
        for q in signed:
            if ((p ^ q) & (1 << 64) - 1).bit_count() <= 4:
                assert groups.get(p, p) == groups.get(q, q)
    tree, values = simhash.Tree(), list(prints)
    for p in values:
        tree.add(p)
    assert all(sorted(tree.near(q, 7)) == sorted(p for p in values if (p ^ q).bit_count() <= 7) for q in values[:50])


def plain_removed(texts):
    bodies = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + 200] for b in bodies for i in range(len(b) - 199))
    out = []
    for b in bodies:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("wide", [150_000, 4])
def test_repeated_strings_go(table, wide, monkeypatch):
    """With the groups merged in memory, and with those of more than four contexts compared as rows."""
    rows, docs = table
    monkeypatch.setattr(suffix_dedup, "WIDE", wide)
    got = suffix_dedup.removed(docs).drop("spans").collect()
    expected = [(r[0], *x) for r, x in zip(rows, plain_removed([r[1] for r in rows]), strict=True)]
    assert ordered((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == ordered(expected)


def test_windows_by_merge_and_by_hash_agree():
    rng = np.random.default_rng(2)
    base = rng.integers(97, 101, 344, dtype=np.uint8)
    bodies = []
    for _ in range(60):
        body = base.copy()
        body[rng.integers(0, 344, rng.integers(0, 3))] = 90
        bodies.append(body.tobytes())
    size = np.array([len(b) for b in bodies])
    off, start, document, once = np.full(60, 144), np.zeros(60, int), np.arange(60), np.ones(60, bool)
    spots = [
        sorted(zip(*(x.tolist() for x in found), strict=True))
        for found in (suffix_dedup._together(bodies, size, start, document, once), suffix_dedup._aligned(bodies, size, off, start, document, once))
    ]
    windows = Counter(b[i : i + 200] for b in bodies for i in range(145))
    assert spots[0] == spots[1] == [(d, i) for d, b in enumerate(bodies) for i in range(145) if windows[b[i : i + 200]] > 1]


def test_texts_without_repeats_keep_their_columns(table):
    rows, docs = table
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert sum(r["text"] is None for r in out.collect()) == sum(r[1] is None for r in rows)


def test_language_of_held_out_texts(table):
    rows, docs = table
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    unknown = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    without = {r[0] for r in rows if r[1] is None or not any(c.isalpha() for c in r[1])}
    assert unknown >= without - {None} and {r["lang_pred"] for r in got} <= {"und", *WORDS}
    if rows is TABLES["ordinary"]:
        held = [(r["lang_pred"], dict((x[0], x[2]) for x in rows)[r["doc_id"]]) for r in got if r["held_out"]]
        assert not unknown and sum(a == b for a, b in held) >= 0.9 * len(held)
    kept = language.known_language(docs)
    assert kept.columns == docs.columns and kept.where("text is null or text = ''").count() == 0


@pytest.mark.parametrize("one_id", [None, 7, 9])
def test_language_where_ids_repeat(spark, one_id):
    """More rows of one id than the sample holds, and of one row: the same share of them is learned from."""
    rng = random.Random(12)
    rows = [(one_id, prose(rng, lang, rng.randrange(20, 60)), lang) for lang in WORDS for _ in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = docs.select(language.held_out(docs["doc_id"]).alias("held")).first()["held"]
    net = language.fit(docs, rows=150)
    assert (net is None) == out
    if net is not None:
        assert net.languages == sorted(WORDS)
    same = spark.createDataFrame([(one_id, "the river over the stone", "en")] * 900, docs.schema)
    assert (language.fit(same, rows=150) is None) == out


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "the river", None), (2, "le fleuve", None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in language.identify(docs).collect()} == {("und", 0.0)}


def test_scores_against_counts(table):
    rows, docs = table
    got = class_lm.score(docs).collect()
    assert len(got) == len(rows)
    held = {r[0]: zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 == 2 for r in rows}
    tokens = [(r[0], [*class_lm.split((r[1] or "").encode()), b""]) for r in rows]
    count = Counter(w for d, ws in tokens for w in ws if not held[d])
    total, kinds = sum(count.values()), len(count)
    expected = ordered(
        (d, held[d], len(ws), sum(count[w] > 0 for w in ws), total, round(sum(np.log10((count[w] + 1) / (total + kinds + 1)) for w in ws), 6)) for d, ws in tokens
    )
    assert ordered((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == expected
    assert all(r["score"] <= 0 for r in got)
    if rows is TABLES["ordinary"]:
        unseen = [r for r in got if r["held_out"]]
        assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_class_model_is_a_distribution(spark, monkeypatch):
    """Over all words of the training texts and one unseen word per signature, the probabilities after any word sum to one."""
    monkeypatch.setattr(class_lm, "OWN", 12)
    texts = spark.createDataFrame([(r[1],) for r in ordinary(60)], "text string")
    counts = class_lm.word_counts(texts)
    model = class_lm.fit(texts, counts)
    units, others = class_lm.Units(model.words), Counter()
    share = np.zeros(len(model.words) + class_lm.SIGNS)
    for r in counts.collect():
        u = units[bytes(r["word"])]
        if u < len(model.words):
            share[u] = 1
        else:
            others[u] += 1
            share[u] += (r["c"] + 1) / (model.rest[u - len(model.words)] + model.distinct[u - len(model.words)] + 1)
    for s in range(class_lm.SIGNS):
        share[len(model.words) + s] += 1 / (model.rest[s] + model.distinct[s] + 1)
    for before in range(len(model.step)):
        assert (10 ** model.step[before][model.of] * 10**model.emit * share).sum() == pytest.approx(1)
    assert len(others) > 1 and model.tokens == sum(len(class_lm.split(r[1].encode())) + 1 for r in ordinary(60))


def test_exchange_separates_what_alternates():
    pairs = np.zeros((6, 6))
    for a in (0, 1, 2):
        for b in (3, 4, 5):
            pairs[a, b] = pairs[b, a] = 10 + a + b
    of = class_lm.exchange(pairs, 2, 10)
    assert of[0] == of[1] == of[2] != of[3] == of[4] == of[5]


def class_table(tokens, of, classes):
    table = np.zeros((classes, classes))
    for a, b in zip([0, *tokens], tokens):
        table[of[a], of[b]] += 1
    return table


def counted_contexts(tokens, units):
    """What a unit's neighbours are, token by token; a text is preceded by its end, unit 0."""

    def contexts(of, classes):
        after, ahead, own = np.zeros((units, classes), int), np.zeros((units, classes), int), np.zeros(units, int)
        for a, b in zip([0, *tokens], tokens):
            after[a, of[b]] += 1
            ahead[b, of[a]] += 1
            own[a] += a == b
        return after, ahead, own

    return contexts


@pytest.mark.parametrize("seed", range(4))
def test_gains_are_those_of_counting_the_text_again(seed):
    rng = np.random.default_rng(seed)
    units, classes = 14, 4
    tokens = [*rng.integers(0, units, 400).tolist(), 3, 3, 3, 0]
    of = rng.integers(0, classes, units)
    of[:classes] = range(classes)
    table = class_table(tokens, of, classes)
    to, gained = class_lm.best_moves(table, of, *counted_contexts(tokens, units)(of, classes))
    stays = class_lm.likelihood(table)
    for u in range(units):
        tried = []
        for k in range(classes):
            moved = of.copy()
            moved[u] = k
            tried.append(class_lm.likelihood(class_table(tokens, moved, classes)) - stays)
        assert gained[u] == pytest.approx(max(tried), abs=1e-6) and tried[to[u]] == pytest.approx(max(tried), abs=1e-6)


@pytest.mark.parametrize("seed", range(4))
def test_exchange_of_all_units_is_the_plain_one(seed):
    """Against the same batches with every gain found by counting the whole text again; every unit takes part."""
    rng = np.random.default_rng(seed)
    units, classes, batches = 18, 3, 5
    kinds = rng.integers(0, classes, units)
    tokens = []
    for _ in range(250):
        k = int(rng.integers(classes))
        tokens += [int(rng.choice(np.flatnonzero(kinds == (k + i) % classes))) if (kinds == (k + i) % classes).any() else 0 for i in range(3)]
    tokens.append(0)
    start = np.minimum(np.arange(units), classes - 1)
    got, table = class_lm.exchange_all(start, classes, counted_contexts(tokens, units), batches)

    of, best, highest = start.copy(), start, -np.inf
    for batch in range(batches + 1):
        now = class_lm.likelihood(class_table(tokens, of, classes))
        if now <= highest:
            break
        best, highest = of, now
        after = of.copy()
        for u in range(batch % 2, units, 2):
            gains = []
            for k in range(classes):
                moved = of.copy()
                moved[u] = k
                gains.append(class_lm.likelihood(class_table(tokens, moved, classes)) - now)
            if max(gains) > 1e-6:
                after[u] = int(np.argmax(gains))
        of = after
    assert got.tolist() == best.tolist() and np.array_equal(table, class_table(tokens, best, classes))
    assert class_lm.likelihood(table) > class_lm.likelihood(class_table(tokens, start, classes))


def test_every_word_is_exchanged(spark, monkeypatch):
    """The model's transitions are those of the text under its classes, also for words past the first and past the own ones."""
    monkeypatch.setattr(class_lm, "OWN", 20)
    monkeypatch.setattr(class_lm, "FIRST", 6)
    rows = [r[1] for r in ordinary(50)]
    texts = spark.createDataFrame([(t,) for t in rows], "text string").repartition(3)
    model = class_lm.fit(texts, class_lm.word_counts(texts))
    units = class_lm.Units(model.words)
    number = len(model.step)
    steps = np.full((number, number), class_lm.ADDED)
    for text in rows:
        tokens = [0, *units.of(class_lm.split(text.encode())), 0]
        for a, b in zip(tokens, tokens[1:]):
            steps[model.of[a], model.of[b]] += 1
    assert np.allclose(model.step, np.log10(steps / steps.sum(1, keepdims=True)))
    late = model.of[6 : len(model.words)]
    assert len(set(late.tolist())) > 1


@pytest.mark.parametrize("seed", range(4))
def test_classes_of_few_tokens_are_the_best_moves(seed):
    rng = np.random.default_rng(seed)
    units, classes = 40, 5
    tokens = [*rng.integers(0, units, 300).tolist(), 3, 3, 3, 0]
    of = rng.integers(0, classes, units)
    of[:classes] = range(classes)
    told = class_table(tokens, of, classes), of, *counted_contexts(tokens, units)(of, classes)
    expected, got = class_lm.best_moves(*told), class_lm.best_classes(*told)
    assert np.array_equal(got[0], expected[0]) and np.allclose(got[1], expected[1])


def test_every_other_word_has_a_class_of_its_own_choice(spark, monkeypatch):
    """Scores against a plain exchange of all words without a unit, each gain found by counting the whole text again."""
    monkeypatch.setattr(class_lm, "OWN", 12)
    monkeypatch.setattr(class_lm, "FIRST", 6)
    monkeypatch.setattr(class_lm, "OTHERS", 5)
    monkeypatch.setattr(class_lm, "HELD", 20)
    rng = random.Random(5)
    sides = [[f"{w}{i}ing" for i in range(15)] for w in "ab"]  # one ending, so one signature, but neighbours of two kinds
    rows = []
    for i in range(90):
        words = [w for _ in range(12) for w in ("the", rng.choice(sides[0]), "of", rng.choice(sides[1]))]
        rows.append((i, " ".join([*words, "so", "so", f"only{i}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in class_lm.score(docs).collect()}

    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    training = docs.where(class_lm.in_training(docs["doc_id"])).select("text")
    model = class_lm.fit(training, class_lm.word_counts(training))
    classes, units = len(model.table), class_lm.Units(model.words)
    texts = {d: [*class_lm.split(t.encode()), b""] for d, t in rows}
    learned = [w for d, ws in texts.items() if not held[d] for w in ws]
    count = Counter(learned)
    start = {w: int(model.of[units[w]]) for ws in texts.values() for w in ws}

    def table(of):
        out = np.zeros((classes, classes))
        for a, b in zip([b"", *learned], learned):
            out[of[a], of[b]] += 1
        return out

    assert np.array_equal(table(start), model.table)
    of, stays = dict(start), class_lm.likelihood(table(start))
    for w in count.keys() - set(model.words):
        gains = [class_lm.likelihood(table(start | {w: k})) - stays for k in range(classes)]
        if max(gains) > 1e-6:
            of[w] = int(np.argmax(gains))
    assert class_lm.likelihood(table(of)) > stays and len({of[w.encode()] for side in sides for w in side}) > 1
    mass = np.zeros(classes)
    for w, c in count.items():
        mass[of[w]] += c + 1
    for s in range(class_lm.SIGNS):
        mass[model.of[len(model.words) + s]] += 1
    steps = np.where(mass > 0, table(of) + class_lm.ADDED, 0)
    steps /= steps.sum(1, keepdims=True)
    for d, ws in texts.items():
        value = sum(np.log10(steps[of[a], of[b]] * (count[b] + 1) / mass[of[b]]) for a, b in zip([b"", *ws], ws))
        assert got[d] == pytest.approx(value)


def test_sums_leave_no_shuffle_files(spark):
    """A vector of several blocks is summed as by hand, and what was exchanged for it is gone at once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    size = 3 * class_lm.BLOCK
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, size, 500).astype("<i4") for _ in range(40)]
    tokens = spark.createDataFrame([(bytearray(t.tobytes()),) for t in texts], "tokens binary").repartition(4)
    tracker = spark._jsc.sc().env().mapOutputTracker()
    before = tracker.shuffleStatuses().size()

    def add(vector, previous, now):
        np.add.at(vector, now, 300)

    got = class_lm.summed(tokens, size, add)
    expected = np.bincount(np.concatenate(texts), minlength=size) * 300
    assert np.array_equal(got, expected) and spark.conf.get(name, None) is None
    assert tracker.shuffleStatuses().size() <= before


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark, tmp_path):
    """Rows that share an id, equal rows, and rows without an id, in groups of their own and beside others."""
    first, second, third = "one river of stone and light", "le lac et la forêt du nord", "der wald und die straße am see"
    rows = [(7, first), (7, first), (7, second), (None, second), (None, third), (None, third), (3, first.upper()), (9, None), (None, "")]
    spark.createDataFrame([(d, t, 1, None) for d, t in rows], "doc_id long, text string, _row int, _doc string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert kept.dtypes == docs.dtypes
    got = ordered((r["doc_id"], (r["text"] or "").lower()) for r in kept.collect())
    assert got == ordered([(3, first), (7, second), (None, third), (9, "")])


def test_near_duplicate_stage_knows_its_rows_in_any_deal(spark, tmp_path):
    """The files are dealt to tasks in another way once the fingerprints are written."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(30)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts * 2)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "doc_id").write.parquet(f"{tmp_path}/d")
    kept = corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{tmp_path}/d"), str(tmp_path))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "2k")
        spark.conf.set(names[1], "1")
        assert sorted(map(tuple, kept.collect())) == sorted(rows[:40])
    finally:
        for n, value in zip(names, before, strict=True):
            spark.conf.set(n, value)


def test_pipeline_stages(table, spark, tmp_path):
    rows, docs = table
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, frames[-1], str(tmp_path)).write.parquet(f"{tmp_path}/{len(frames)}")
        frames.append(spark.read.parquet(f"{tmp_path}/{len(frames)}"))
        assert frames[-1].dtypes == docs.dtypes
    known, single, unique, mixed = (f.collect() for f in frames[1:])
    assert all(any(c.isalpha() for c in r["text"]) for r in known)
    _, lowest = plain_groups([r["doc_id"] for r in known], [plain_fingerprint(r["text"]) for r in known])
    assert ordered(r["doc_id"] for r in single) == ordered(lowest.values())  # one row of each group, null ids and equal rows included
    assert {tuple(r) for r in single} <= {tuple(r) for r in known}
    assert all(r["n_chars"] == len(r["text"]) for r in (*unique, *mixed))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(mixed)
