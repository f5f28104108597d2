"""Every llm query on small tables: SQL oracles, and plain brute-force versions where SQL can't say it."""

import base64
import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest

from telemetra.llm import queries as Q

BLANK = " \t\n\x0b\x0c\r"


def collected(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", sorted(set(Q.ORACLES) - {"op12_hard_negatives", "op13_prefix_trie"}))
def test_sql_oracle(spark, unique_table, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{unique_table}/documents.parquet/*.parquet')")
    want = con.execute(Q.ORACLES[name])
    cols = [d[0] for d in want.description]
    got = Q.QUERIES[name](spark, unique_table)
    assert sorted(got.columns) == sorted(cols)
    order = sorted(cols)

    def key(r):
        return tuple(round(r[c], 6) if isinstance(r[c], float) else r[c] for c in order)

    assert sorted(map(repr, (key(dict(zip(cols, r))) for r in want.fetchall()))) == \
        sorted(map(repr, (key(r) for r in collected(got))))


def test_op1_every_window(spark, table, rows):
    length = 200
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = collections.Counter(t[p:p + length] for _, t in texts for p in range(len(t) - length + 1))
    want = collections.Counter()
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[(i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    got = collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                              for r in collected(Q.op1_suffix_array_dedup(spark, table)))
    assert got == want
    assert sum(k[2] for k in want) > 0


def test_op1_shorter_strings(spark):
    """Overlapping repeats within one document, and a small length."""
    from telemetra.llm.suffix_dedup import remove_duplicates
    df = spark.createDataFrame([(1, "ab" * 60), (2, "x" * 10 + "q" * 45 + "y" * 10), (3, "q" * 45 + "z")],
                               "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], bytes(r["kept"])) for r in collected(remove_duplicates(df, length=40))}
    assert got[1] == (120, b"")
    assert got[2] == (45, b"x" * 10 + b"y" * 10)
    assert got[3] == (45, b"z")


def test_op1_rows_of_one_id(spark):
    """A row loses nothing because another row of its id holds a repeated string."""
    import random

    from telemetra.llm.suffix_dedup import remove_duplicates
    rng = random.Random(6)
    a, b, c, d = ("".join(rng.choices("abcdefghij ", k=420)) for _ in range(4))
    rows = [(1, a + b), (1, c + d), (2, a), (None, c[:50]), (None, d + a), (3, b[:100]), (1, a + b)]
    got = collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["kept"]).decode())
                              for r in collected(remove_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert got == {(1, 840, 840, ""): 2, (1, 840, 420, c): 1, (2, 420, 420, ""): 1, (None, 50, 0, c[:50]): 1,
                   (None, 840, 840, ""): 1, (3, 100, 0, b[:100]): 1}


def test_op3_tokenizer_library(spark, table, rows):
    import public_tokenizers as P
    import tiktoken
    with open(P.path(Q.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = collections.Counter()
    for r in rows:
        t = r[1] or ""
        ids = lib.encode_ordinary(t)
        want[(r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(t.encode()).hexdigest())] += 1
    got = collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                              for r in collected(Q.op3_byte_bpe(spark, table)))
    assert got == want


def test_op3_codec_on_odd_strings():
    import random

    import public_tokenizers as P
    import tiktoken

    from telemetra.llm.bpe import Codec, PerfectHash, read_ranks
    tokens = read_ranks(P.path(Q.VOCABULARY))
    table = PerfectHash(tokens)
    assert sorted(table.candidate(t) for t in tokens) == list(range(len(tokens)))
    codec = Codec(tokens, table, P.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)},
                            special_tokens={})
    rng = random.Random(3)
    alphabet = list("abcdeé ñß  \n\t\r\x0b\x1c\x85\xa0　 .,!'’st123½ 漢字😀́​$%")
    for _ in range(3000):
        s = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
        ids = codec.encode(s)
        assert ids == lib.encode_ordinary(s)
        assert codec.decode(ids) == s.encode()
    assert codec.encode("a" * 5000 + "bc" * 3000) == lib.encode_ordinary("a" * 5000 + "bc" * 3000)


def shingle_sets(rows):
    out = collections.defaultdict(list)
    for r in rows:
        lowered = re.sub("[A-Z]+", lambda m: m.group().lower(), r[1] or "")
        w = re.findall(f"[^{BLANK}]+", lowered)
        out[r[0]].append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def components_of(sets):
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_op4_all_pairs(spark, table, rows):
    sets = shingle_sets(rows)
    want = components_of(sets)
    got = collected(Q.op4_ngram_jaccard_join(spark, table))
    assert len(got) == len(rows)
    for r in got:
        assert r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}
        assert r["component_id"] == want[r["doc_id"]], r
    assert len(set(want.values())) < len(want) - 5


def test_op4_frequent_tokens(spark, monkeypatch):
    """Common passages, chains and clusters with a low bound on frequent tokens: the result stays exact."""
    import random

    from telemetra.llm import jaccard_join as J
    monkeypatch.setattr(J, "FREQUENT", 2)
    monkeypatch.setattr(J, "SLACK", 4)
    rng = random.Random(7)

    def words(n):
        return ["w%d" % rng.randrange(5000) for _ in range(n)]

    common, rows = words(40), []
    for c in range(6):
        base = words(80) + (common if c % 2 else [])
        for k in range(6):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = "e%d" % rng.randrange(10 ** 6)
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + k, " ".join(words(6) + common + words(6))) for k in range(8)]
    want = components_of(shingle_sets(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in collected(J.jaccard_components(df))} == want


def repeated_and_null_ids():
    """Near copies without ids, and one id with a text that has a copy, one that has a near copy and a lonely one."""
    import random
    rng = random.Random(11)

    def words(n):
        return ["w%d" % rng.randrange(5000) for _ in range(n)]

    def edited(w, k):
        return " ".join(w[:k] + ["e%d" % k] + w[k + 1:])

    a, b, c, d, lonely = (words(80) for _ in range(5))
    rows = [(None, edited(a, 3)), (None, edited(a, 70)), (None, " ".join(words(60))),
            (None, edited(d, 5)), (21, edited(d, 75)),
            (7, " ".join(b)), (3, " ".join(b)),
            (7, edited(c, 2)), (30, edited(c, 77)),
            (7, " ".join(lonely))]
    return [(i, t, "en", "s", len(t)) for i, t in rows]


def test_op4_repeated_and_null_ids(spark):
    from telemetra.llm.jaccard_join import jaccard_components

    from .conftest import frame
    rows = repeated_and_null_ids()
    got = collections.Counter((r["doc_id"], r["component_id"])
                              for r in collected(jaccard_components(frame(spark, rows).repartition(3))))
    assert got == collections.Counter({(None, None): 3, (None, 21): 1, (21, 21): 1, (7, 3): 3, (3, 3): 1, (30, 3): 1})


def test_pipeline_near_copies_by_row(spark):
    import corpus_pipeline as C

    from .conftest import frame
    rows = repeated_and_null_ids()
    left = collected(C.drop_near_copies(spark, frame(spark, rows).repartition(3), ""))
    texts = [r["text"] for r in left]
    assert len(texts) == 6 and len(set(texts) & {rows[0][1], rows[1][1]}) == 1
    assert {rows[2][1], rows[4][1], rows[6][1], rows[7][1], rows[9][1]} <= set(texts)
    assert (3, rows[6][1]) in {(r["doc_id"], r["text"]) for r in left}


def test_op5_held_out_accuracy(spark, table, rows):
    got = collected(Q.op5_language_id(spark, table))
    assert len(got) == len(rows)
    truth = {r[0]: r for r in rows}
    right = total = 0
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        text, lang = truth[r["doc_id"]][1:3]
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        assert r["lang_pred"] in ("en", "de", "fr") and 0 <= r["score"] <= 1
        if lang and r["held_out"] and len(text) > 40:
            total += 1
            right += r["lang_pred"] == lang
    assert total > 3 and right >= 0.9 * total


def test_op5_sample_is_bounded(spark, monkeypatch):
    """One text under thousands of ids, and under one id: the driver sees at most fit_rows rows of a language."""
    from telemetra.llm import langid
    seen = []
    train = langid.train_ftrl
    monkeypatch.setattr(langid, "train_ftrl", lambda rows, *a, **k: (seen.extend(r[2] for r in rows), train(rows, *a, **k))[1])
    rows = [(i, "the very same words of one text", "en") for i in range(4000)]
    rows += [(8, "die immer gleichen worte", "de")] * 900 + [(i, f"andere worte {i}", "de") for i in range(9000, 9400)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), fit_rows=60)
    assert model.languages == ["de", "en"]
    counts = collections.Counter(seen)
    assert set(counts) == {0, 1} and max(counts.values()) <= 60 and counts[1] >= 30


def test_op5_nothing_to_learn(spark):
    from telemetra.llm import langid
    df = spark.createDataFrame([(1, "some text", None, "s")], "doc_id long, text string, lang string, source string")
    assert [(r["lang_pred"], r["score"]) for r in collected(langid.predict(df, langid.fit(df)))] == [("und", 0.0)]


def test_op6_law(spark, table, rows):
    got = collected(Q.op6_histogram_sort_shards(spark, table))
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == collections.Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    shards = collections.defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))


def test_op6_near_equal(spark):
    import random

    from telemetra.llm.sharding import shard_by_bytes
    rng = random.Random(5)
    rows = [(i, "x" * rng.randint(0, 400) if i % 3 else "the same text") for i in range(3000)]
    got = collected(shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string")))
    sizes = collections.Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    ideal = sum(sizes.values()) / 8
    assert len(sizes) == 8 and max(abs(s - ideal) for s in sizes.values()) < 0.02 * ideal
    again = collected(shard_by_bytes(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5)))
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in got} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


@pytest.mark.parametrize("ids", ["distinct", "null"])
def test_op6_group_larger_than_a_shard(spark, ids):
    """A third to a half of all rows are one text: shards end inside its group."""
    import random

    from telemetra.llm.sharding import shard_by_bytes
    rng = random.Random(8)
    rows = [(i, "".join(rng.choices("abcdef", k=rng.randint(0, 100)))) for i in range(3000)]
    rows += [(5000 + i if ids == "distinct" else None, "the one text of fifty-odd characters, held very often")
             for i in range(3000)]
    got = collected(shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    sizes = collections.Counter()
    slots = collections.defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    ideal = sum(sizes.values()) / 8
    assert len(sizes) == 8 and max(abs(s - ideal) for s in sizes.values()) < 0.02 * ideal
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def wanted_targets(sizes):
    """Sources in order (null last); excess over three times the size is shared again by weight."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: 3 * sizes[s] for s in over})


def test_op8_targets(spark, table, rows):
    got = collected(Q.op8_source_mix(spark, table))
    words = {r[0]: len(re.findall(f"[^{BLANK}]+", r[1] or "")) for r in rows}
    source = {r[0]: r[3] for r in rows}
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += words[r[0]]
    goal = wanted_targets(dict(sizes))
    taken = collections.Counter()
    for r in got:
        assert r["size"] == words[r["doc_id"]] and r["source_size"] == sizes[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(goal[source[r["doc_id"]]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 1 for s in goal) and len(got) == len(rows)
    again = collected(Q.op8_source_mix(spark, table))
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_op8_tree_and_pieces(spark, table):
    from telemetra.llm.mixing import mix, shuffled, splitting_tree
    quotas = [1000, 0, 37, 512]
    tree = np.array(splitting_tree(quotas, 8, seed=3))
    assert tree.sum(axis=0).tolist() == quotas
    assert tree.sum(axis=1).max() - tree.sum(axis=1).min() <= 3
    assert splitting_tree(quotas, 8, seed=3) == tree.tolist()
    _, pieces = mix(Q.documents(spark, table), block_words=16)
    listed = [(r["shard"], r["order_key"]) for r in collected(shuffled(pieces))]
    assert listed == sorted(listed)
    covered = collections.defaultdict(list)
    for r in collected(pieces):
        covered[(r["row"], r["pass"])].append((r["first_word"], r["first_word"] + r["n_words"]))
    for spans in covered.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_op8_documents_of_repeated_ids(spark):
    """Texts of equal length without an id, or with one that repeats, give their own pieces only."""
    from telemetra.llm.mixing import mixed_documents
    rows = [(None if i < 6 else 5, " ".join(f"{c}{i}" for c in "abcdefg"), "ab"[i % 2], 0) for i in range(12)]
    rows += [(100 + i, " ".join(f"{c}{i}" for c in "pqr"), "c", 0) for i in range(4)]
    got = collected(mixed_documents(spark.createDataFrame(
        rows, "doc_id long, text string, source string, n_chars long").repartition(3), block_words=4))
    sizes, taken, words = collections.Counter(), collections.Counter(), collections.Counter()
    for _, text, source, _ in rows:
        sizes[source] += len(text.split())
    owner = {w: (r[0], r[2]) for r in rows for w in r[1].split()}
    for r in got:
        taken[r["source"]] += len(r["text"].split())
        words.update(r["text"].split())
        assert {owner[w] for w in r["text"].split()} == {(r["doc_id"], r["source"])}
    goal = wanted_targets(dict(sizes))
    assert all(abs(taken[s] - goal[s]) <= 1 for s in goal)
    assert max(words.values()) <= 3


def test_op9_repeated_rows(spark, table, rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups["".join(c for c in r[1] or "" if c not in BLANK)].append(r)
    want, kept = collections.Counter(), 0
    for norm, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1] or ""), r[0]))[0]
        for r in own:
            want[(r[0], keep, len(own), hashlib.sha256(norm.encode()).hexdigest())] += 1
    got = collected(Q.op9_exact_dedup(spark, table))
    assert collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = (("assign", ASSIGN, lambda m: len(m.group(2)) >= 6),
         ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
         ("hex", re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 24))


def test_op10_places(spark, table, rows):
    truth = {}
    for r in rows:
        spans = sorted((m.start(), k, name, m.end()) for k, (name, p, good) in enumerate(KINDS)
                       for m in p.finditer(r[1] or "") if good(m))
        truth[r[0]] = spans
    got = collected(Q.op10_secret_scan(spark, table))
    assert len(got) == len(rows) and sum(map(len, truth.values())) > 10
    for r in got:
        spans = truth[r["doc_id"]]
        listed = [f"{name}:{a}:{b}" for a, _, name, b in spans]
        assert hashlib.sha256(",".join(listed).encode()).hexdigest() == r["base_sha256"]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("owned")] == listed


def test_op10_ownership(spark):
    mine, common = "Zk9" + "aB3dE5" * 4, "Xy7" + "Qw2eR4" * 4
    rows = [(1, f"see {mine} here", "a"), (2, f"{common}", "a"), (3, f"x {common}", "b"), (4, f"{common} y", "c"),
            (5, f"again {mine}", "a"), (6, "secret=abcdefgh", "a"), (7, "secret=abcdefgh", "b"),
            (8, "secret=abcdefgh", "c"), (9, "\ue000" + mine, "a")]
    from telemetra.llm.secret_scan import secret_scan
    got = {r["doc_id"]: r for r in collected(secret_scan(spark.createDataFrame(
        rows, "doc_id long, text string, source string")))}
    assert got[1]["spans"] == f"owned:4:{4 + len(mine)}" and got[5]["n_live"] == 1
    assert got[9]["spans"] == f"owned:1:{1 + len(mine)}"
    assert all(got[i]["spans"] == "" for i in (2, 3, 4))
    assert all(got[i]["spans"] == "assign:0:15" and got[i]["n_examples"] == 1 for i in (6, 7, 8))


def test_pipeline(spark, unique_table, unique_rows):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{unique_table}/documents.parquet")
    columns = docs.columns
    kept = {}
    from telemetra.llm.common import stored
    for name, apply in C.STAGES:
        docs = stored(apply(spark, docs, unique_table), f"test-{name}")
        kept[name] = collected(docs)
        assert name == "byte_bpe" or docs.columns == columns
    named = [name for name, _ in C.STAGES]
    assert named == ["language_id", "exact_dedup", "ngram_jaccard_join", "source_mix", "byte_bpe"]
    lang = {r["doc_id"] for r in kept["language_id"]}
    assert {r[0] for r in unique_rows if len(r[1] or "") > 200} <= lang
    assert not lang & {900, 901, 902, 903}
    strip = {r[0]: "".join(c for c in r[1] or "" if c not in BLANK) for r in unique_rows}
    exact = [r["doc_id"] for r in kept["exact_dedup"]]
    assert sorted(strip[i] for i in exact) == sorted({strip[i] for i in lang})
    left = [r for r in unique_rows if r[0] in set(exact)]
    comp = components_of(shingle_sets(left))
    assert sorted(r["doc_id"] for r in kept["ngram_jaccard_join"]) == sorted(set(comp.values()))
    words = collections.Counter()
    for r in kept["source_mix"]:
        words[r["source"]] += len(re.findall(f"[^{BLANK}]+", r["text"]))
    sizes = collections.Counter()
    for r in kept["ngram_jaccard_join"]:
        sizes[r["source"]] += len(re.findall(f"[^{BLANK}]+", r["text"]))
    goal = wanted_targets(dict(sizes))
    assert all(abs(words[s] - goal[s]) <= 1 for s in goal)
    digests = collections.Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest())
                                  for r in kept["source_mix"])
    assert digests == collections.Counter((r["doc_id"], r["decoded_sha256"]) for r in kept["byte_bpe"])
