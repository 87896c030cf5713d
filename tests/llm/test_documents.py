"""Near-duplicates, token counts, decontamination."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from gridtally.llm import decontamination_wm as wm
from gridtally.llm import queries, simhash_ball, token_prefix
from gridtally.llm.common import table
from gridtally.llm.components import connected_components


def _components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {n: root(n) for n in nodes}


def test_components_of_chains_stars_and_repeats(spark):
    chain = [(i, i + 1) for i in range(1000, 1100)]
    links = chain + [(5, i) for i in range(6, 300)] + [(7, 7), (None, 3), (2, 1), (1, 2), (400, 2)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(4)
    found = {r.node: r.component for r in connected_components(frame).collect()}
    known = [(a, b) for a, b in links if a is not None and a != b]
    assert found == _components({n for link in known for n in link}, known)
    assert connected_components(frame.limit(0)).count() == 0


def _plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + n]).encode(), seed=42).intdigest() for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_every_pair_within_the_radius_shares_a_key():
    rng = random.Random(0)
    for bits in range(6):
        keys = simhash_ball.variants(bits)
        if len(keys) > 5000:
            continue
        for _ in range(60):
            a = rng.getrandbits(64)
            b = a ^ sum(1 << i for i in rng.sample(range(64), bits))
            assert {(k, a & k ^ f) for k, f in keys} & {(k, b & k ^ f) for k, f in keys}


@pytest.mark.parametrize("limit", [50_000, 3])
def test_near_duplicates_by_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash_ball, "GROUP_LIMIT", limit)
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    values = set(seeds) | {0}
    for seed in seeds:
        at = seed
        for _ in range(rng.randrange(12)):
            at ^= sum(1 << i for i in rng.sample(range(20 if rng.random() < 0.5 else 64), rng.randrange(1, 5)))
            values.add(at)
    signed = [simhash_ball._signed(v) for v in values]
    links = simhash_ball.near_pairs(spark.createDataFrame([(v,) for v in signed], "fp long"))
    found = {(r.a, r.b) for r in links.collect()}
    close = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    assert found <= set(close)
    assert _components(signed, found) == _components(signed, close)


def test_a_key_over_the_limit_is_emitted_to_its_last_row(spark):
    # 40 fingerprints of which only the first and the last are near, between keys that share its last batch.
    far = [(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1) - (1 << 63) for i in range(1, 40)]
    rows = [(key, fp) for key in range(12) for fp in [*far, far[0] ^ 1]]
    keyed = spark.createDataFrame(rows, "key long, fp long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = simhash_ball._compared(keyed, 3, 20).collect()
        links = simhash_ball._compared(keyed, 3, None).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted((r.a, r.b) for r in found if r.again) == sorted(rows)
    assert {(r.a, r.b) for r in links} == {tuple(sorted((far[0], far[0] ^ 1)))}


def test_simhash_query_by_brute_force(spark, sf_medium):
    texts = {r.doc_id: r.text for r in table(spark, sf_medium, "documents").collect()}
    prints = {i: _plain_fingerprint(t) for i, t in texts.items()}
    ids = sorted(prints)
    close = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    wanted = _components(ids, close)
    rows = queries.op4_simhash_ball(spark, sf_medium).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{prints[i]:016x}", wanted[i]) for i in ids
    }


def test_near_duplicates_of_odd_documents(odd_documents):
    rows = simhash_ball.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id[1] == by_id[2] == by_id[3] == 1
    assert by_id[5] == 4 and by_id[7] == 6 and {by_id[100 + i] for i in range(300)} == {100}
    kept = simhash_ball.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [-3, 0, 1, 4, 6, 8, 9, 10, 11, 11, 100]  # two unrelated texts share the id 11
    assert kept.where("doc_id is null").count() == 1  # the other row without id has no words, like row 1
    assert simhash_ball.keep_one(odd_documents.limit(0)).count() == 0


def test_each_group_keeps_one_row_whatever_its_ids(spark):
    rng = random.Random(9)
    texts = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(60)) for _ in range(8)]
    copied = texts[3]
    rows = [
        (11, texts[0]), (11, texts[1]), (12, texts[1]),  # one id, two groups
        (7, texts[2]), (7, texts[2]), (None, texts[2]),  # repeated rows, a copy without id
        *[(None, copied)] * 40, *[(None, texts[4])] * 2, (None, texts[5]),  # groups without any id
        (None, None), (None, ""), (3, " "), (5, texts[6]), (4, texts[6]), (4, texts[7]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    kept = [tuple(r) for r in simhash_ball.keep_one(docs).collect()]
    assert sorted(kept, key=repr) == sorted(
        [
            (11, texts[0]), (11, texts[1]), (7, texts[2]), (None, copied), (None, texts[4]), (None, texts[5]),
            (3, " "), (4, texts[6]), (4, texts[7]),
        ],
        key=repr,
    )


# Token counts.


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = public.path(queries.TOKENIZER)
    return tokenizers.Tokenizer.from_file(path), open(path, encoding="utf-8").read()


def test_prefix_counts_equal_the_library(tokenizer):
    library, content = tokenizer
    vocabulary = token_prefix.Vocabulary(content)
    count = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    letters = [*"abdeilnrst 'Bé   \n\t12!?.\"<|>ß中\x1c\x85​😀", "<|endoftext|>", "'re", "'ll", " the", "\r\n", "ing"]
    rng = random.Random(2)
    for _ in range(250):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        counts = [count(text[:i]) for i in range(len(text) + 1)]
        prefixes = vocabulary.prefixes(text)
        assert prefixes.tolist() == counts
        for budget in (0, 1, 4, 9):
            assert token_prefix.cut(prefixes, budget) == max(i for i, n in enumerate(counts) if n <= budget)


def test_pairs_stay_as_merging_leaves_them(tokenizer):
    vocabulary = token_prefix.Vocabulary(tokenizer[1])
    assert vocabulary.rising
    rng = random.Random(4)
    tokens = list(vocabulary.ids.values())
    for _ in range(20_000):
        left, right = rng.choice(tokens), rng.choice(tokens)
        whole = vocabulary.bytes_of[left]
        if rng.random() < 0.5 and len(whole) > 1:  # two tokens whose bytes are a token
            at = rng.randrange(1, len(whole))
            left, right = (vocabulary.ids.get(part, left) for part in (whole[:at], whole[at:]))
        merged = vocabulary.merged(vocabulary.bytes_of[left] + vocabulary.bytes_of[right])
        assert vocabulary.stable(left, right) == (merged == [left, right])


def test_one_lookup_answers_inside_a_long_piece(tokenizer, monkeypatch):
    library, content = tokenizer
    vocabulary = token_prefix.Vocabulary(content)
    text = "ab" * 500_000
    looked_up = []
    monkeypatch.setattr(vocabulary, "total", lambda t: looked_up.append(t))
    prefixes = vocabulary.prefixes(text)
    assert not looked_up and len(prefixes) == len(text) + 1
    for size in (1, 2, 333, 10_001):
        assert prefixes[size] == len(library.encode(text[:size], add_special_tokens=False).ids)


def test_only_some_places_are_split_again(tokenizer, monkeypatch):
    vocabulary = token_prefix.Vocabulary(tokenizer[1])
    again = []
    total = vocabulary.total
    monkeypatch.setattr(vocabulary, "total", lambda text: again.append(text) or total(text))
    vocabulary.prefixes("Plain prose, with 12 numbers... and it's one's own.\nNew line " * 50)
    assert not again
    vocabulary.prefixes("two  gaps \n here, they're shortened")
    assert again == ["'", "r", "  ", " \n "]


def test_token_query_equals_the_library(spark, sf_medium, tokenizer):
    texts = {r.doc_id: r.text for r in table(spark, sf_medium, "documents").collect()}
    for row in queries.op5_token_prefix(spark, sf_medium).collect():
        n = len(tokenizer[0].encode(texts[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_tokens, row.over_limit) == (n, n > 512)
        assert row.n_bytes == len(texts[row.doc_id].encode())


def test_tokens_of_odd_documents(odd_documents, tokenizer):
    library, content = tokenizer
    rows = odd_documents.select("text", token_prefix.token_counts(F.col("text"), content, 16).alias("c")).collect()
    for row in rows:
        assert row.c.n_tokens == len(library.encode(row.text or "", add_special_tokens=False).ids)
        cut = (row.text or "")[: row.c.cut]
        assert len(library.encode(cut, add_special_tokens=False).ids) <= 16
    tables = odd_documents.select("text", token_prefix.prefix_counts(F.col("text"), content).alias("t")).collect()
    for row in tables:
        assert len(row.t) == len(row.text or "") + 1 and row.t[0] == 0
        assert row.t[-1] == len(library.encode(row.text or "", add_special_tokens=False).ids)


# Decontamination.


def _plain_search(text, items):
    found = wm.words(text)
    hit, ids = set(), set()
    for item, other in items:
        for string in wm.windows(other):
            for at in range(len(found) - len(string) + 1):
                if tuple(found[at : at + len(string)]) == string:
                    hit.update(range(at, at + len(string)))
                    ids.add(item)
    return len(found), len(hit), ids


@pytest.mark.parametrize("set_bytes", [1 << 20, 60])
def test_search_by_brute_force(spark, set_bytes):
    rng = random.Random(6)
    draw = lambda n: " ".join(rng.choice("ab cd EF, é g".split()) for _ in range(n))
    items = [(i, draw(rng.choice([1, 2, 3, 5, 14, 20]))) for i in range(12)]
    items += [(99, items[0][1]), (50, None), (51, "!?"), (None, "zz yy"), (98, "zz yy")]
    texts = [draw(rng.randrange(60)) + " " + (rng.choice(items)[1] or "") for _ in range(60)]
    texts += [None, "", "...", "ZZ-yy zz", "word " * 3000 + items[-1][1]]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    known = [(str(i) if i is not None else None, t) for i, t in items]
    for row in wm.find_benchmark(docs, bench, set_bytes).collect():
        n_words, n_hit, ids = _plain_search(texts[row.doc_id], known)
        assert (row.n_words, sum(r.end - r.start for r in row.runs)) == (n_words, n_hit)
        assert row["items"] == sorted(i for i in ids if i is not None)


def test_one_text_under_many_ids_is_searched_in_several_sets(spark, monkeypatch):
    sizes = []
    make = wm._strings
    monkeypatch.setattr(wm, "_strings", lambda items: sizes.append(items.distinct().count()) or make(items))
    bench = spark.range(2000).selectExpr("id as item_id", "'one shared text' as text")
    docs = spark.createDataFrame([(1, "here is one shared text again"), (2, "none")], "doc_id long, text string")
    rows = {r.doc_id: r for r in wm.find_benchmark(docs, bench.union(bench), set_bytes=4000).collect()}
    assert len(rows[1]["items"]) == 2000 and [tuple(r) for r in rows[1].runs] == [(2, 5)]
    assert rows[2]["items"] == [] and rows[2].runs == []
    assert len(sizes) > 5 and max(sizes) < 1000


def test_contaminated_documents_go(spark, odd_documents):
    bench = spark.createDataFrame([(1, "copied text of many documents here")], "item_id long, text string")
    kept = wm.keep_clean(odd_documents, bench)
    assert kept.columns == odd_documents.columns
    assert kept.count() == odd_documents.count() - 300
    assert wm.keep_clean(odd_documents, bench.limit(0)).count() == odd_documents.count()
    assert wm.keep_clean(odd_documents.limit(0), bench).count() == 0
