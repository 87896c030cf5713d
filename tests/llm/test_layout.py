"""Mixing, embeddings, archives, shards, and the pipeline."""

import gzip
import hashlib
import io
from collections import Counter
from hashlib import md5
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridtally.llm import embedding_itq, hilbert_shards, queries, source_schedule, warc_revisits
from gridtally.llm.common import discard, table, totals_before


def _frames(spark, sf_dir, name):
    connection = duckdb.connect()
    for view in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{sf_dir}/{view}.parquet'")
    found = queries.QUERIES[name](spark, sf_dir)
    wanted = connection.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    return Counter(map(tuple, found.select(*columns).collect())), Counter(wanted.fetchall())


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_sql(spark, sf_medium, name):
    found, wanted = _frames(spark, sf_medium, name)
    assert found == wanted and found


# Mixing.


def test_targets_by_resharing(spark):
    rows = [(i, s, n) for i, (s, n) in enumerate([("a", 1000), ("b", 10), ("c", 10), (None, 400), ("", 7), ("z", 0)])]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = {r.source: r.target for r in source_schedule.source_targets(sizes).collect()}
    order = ["", "a", "b", "c", "z", None]
    size = {"": 7, "a": 1000, "b": 10, "c": 10, "z": 0, None: 400}
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), float(sum(size.values()))
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in share:
            target[s] += share[s]
            if target[s] >= 3 * size[s]:
                left += target[s] - 3 * size[s]
                target[s] = 3 * size[s]
                open_.discard(s)
    assert found == pytest.approx(target)


@pytest.mark.parametrize("block_words", [1, 7, 4096])
def test_mix_of_odd_documents(odd_documents, block_words):
    rows = source_schedule.mix(odd_documents, block_words).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, abs=0.51)
        assert sum(r.size for r in own) == own[0].source_size
    again = source_schedule.mix(odd_documents.repartition(2), block_words).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert source_schedule.mix(odd_documents.limit(0)).count() == 0


def test_totals_before_by_brute_force(spark):
    rows = [(g, i, (i * 7 + len(g or "")) % 11) for g in ("a", "b", None) for i in range(0, 200, 3)]
    frame = spark.createDataFrame(rows, "g string, at long, n long")
    found = totals_before(frame, ["g"], "at", F.floor(F.col("at") / 16), "n", "before").collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.before == sum(n for g, i, n in rows if g == r.g and i < r["at"])
    assert totals_before(frame.limit(0), ["g"], "at", F.col("at"), "n", "before").count() == 0


def test_streams_follow_the_hash_whatever_the_chunks(spark, monkeypatch):
    monkeypatch.setattr(source_schedule, "COARSE_DIGITS", 1)
    sizes = spark.range(3000).selectExpr("id doc_id", "if(id % 3 = 0, null, 's') source", "id % 13 size")
    targets = source_schedule.source_targets(sizes)
    rows = source_schedule.streams(sizes, targets, chunk_rows=10).collect()
    assert len(rows) == 3000
    for source in (None, "s"):
        own = [r for r in rows if r.source == source]
        at = 0
        for r in sorted(own, key=lambda r: md5(f"mix:{r.doc_id}".encode()).hexdigest()):
            assert r.start == at
            at += r["size"]


def test_schedule_is_even_at_any_time(spark):
    targets = spark.createDataFrame(
        [("a", 5, 50_000, 30_000.0), ("b", 5, 3_000, 9_000.0), (None, 1, 90_000, 61_000.0)],
        "source string, documents long, source_size long, target double",
    )
    slots = source_schedule.schedule(targets, 100).orderBy("slot").collect()
    assert [s.slot for s in slots] == list(range(1000))
    assert Counter(s.source for s in slots) == {"a": 300, "b": 90, None: 610}
    seen = Counter()
    for at, s in enumerate(slots, 1):
        assert s["rank"] == seen[s.source]
        seen[s.source] += 1
        assert abs(seen["a"] - 0.3 * at) < 1 + np.log(at + 1)  # golden-ratio points: logarithmic
    assert sum(s.words for s in slots) == 100_000


def test_documents_are_repeated_as_the_mix_reads_them(odd_documents):
    kept = source_schedule.mixed(odd_documents)
    assert kept.columns == odd_documents.columns
    assert set(r.doc_id for r in kept.collect()) <= set(r.doc_id for r in odd_documents.collect())
    assert source_schedule.mixed(odd_documents.limit(0)).count() == 0


def _rows_of_few_ids(spark):
    """Rows of which a third have no id and a third share an id with rows of other sources, each with a text of its own."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(1500):
        doc_id = (None, 5000 + i % 90, i)[i % 3]
        text = " ".join([f"t{i}"] + ["w"] * int(rng.integers(0, 40))) if i % 50 else (None, "", " ")[i % 3]
        rows.append((doc_id, text, ("a", "b", "c", "d", None)[i % 5 if i % 7 else 0]))
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)


def test_rows_are_repeated_each_as_the_mix_reads_them(spark, monkeypatch):
    monkeypatch.setattr(source_schedule, "BLOCK_WORDS", 16)
    docs = _rows_of_few_ids(spark)
    read = source_schedule.mix(docs, 16).collect()
    wanted = Counter()
    for r in read:
        times = int(r.taken / r.size + 0.5) if r.size else 1
        wanted[r.doc_id, r.source, r.size, times] += 1
    kept = Counter((r.doc_id, r.source, r.text) for r in source_schedule.mixed(docs).collect())
    found = Counter()
    for r in docs.where("text like 't%'").collect():
        found[r.doc_id, r.source, len(r.text.split()), kept[r.doc_id, r.source, r.text]] += 1
    assert found == Counter({k: n for k, n in wanted.items() if k[2]})
    assert {k[3] for k in found if k[0] is None} >= {0, 1}
    assert sum(n for k, n in kept.items() if not (k[2] or "").strip()) == sum(n for k, n in wanted.items() if not k[2])


def test_mix_of_rows_without_id_equals_sql(spark, monkeypatch):
    monkeypatch.setattr(source_schedule, "COARSE_DIGITS", 1)
    monkeypatch.setattr(source_schedule.streams, "__defaults__", (4,))
    docs = _rows_of_few_ids(spark)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?)", [tuple(r) for r in docs.collect()])
    wanted = connection.execute(queries.ORACLE_SQL["op6_source_schedule"]).fetchall()
    found = source_schedule.mix(docs).select("doc_id", "size", "source_size", "target", "taken")
    assert Counter(map(tuple, found.collect())) == Counter(wanted)


def test_rows_without_id_are_spread_over_chunks(spark):
    sizes = spark.range(4000).selectExpr("if(id % 4 = 0, id, null) doc_id", "'s' source", "7L size", "id row")
    targets = source_schedule.source_targets(sizes)
    chunks = source_schedule._chunked(sizes, targets, 100)
    assert chunks.groupBy("source", "chunk").count().agg(F.max("count")).first()[0] < 100
    starts = source_schedule.streams(sizes, targets, chunk_rows=100).select("start")
    assert sorted(r.start for r in starts.collect()) == [7 * i for i in range(4000)]


# Embeddings.


def test_recall_and_links_by_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(1500, 64))
    near = base[rng.integers(0, 1500, 1500)] + rng.normal(size=(1500, 64)) * rng.uniform(0.1, 0.45, (1500, 1))
    vectors = np.concatenate([base, near]).astype(np.float32)
    labels = np.zeros(len(vectors), int)
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, labels))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = embedding_itq.near_duplicates(frame).toPandas().set_index("vec_id").sort_index()
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.93
    np.fill_diagonal(linked, False)
    assert found.n_links.sum() >= 0.9 * linked.sum()
    assert (found.n_links.to_numpy() <= linked.sum(1)).all()


@pytest.mark.parametrize("key_rows", [2_000, 5])
def test_odd_vectors(spark, monkeypatch, key_rows):
    monkeypatch.setattr(embedding_itq.near_pairs, "__defaults__", (key_rows,))
    rng = np.random.default_rng(1)
    a = rng.normal(size=64).tolist()
    turned = (np.array(a) * 3).tolist()
    close = [(np.array(a) + rng.normal(size=64) * 0.02).tolist() for _ in range(25)]
    rows = [(1, a, 1), (2, a, 1), (3, turned, 1), (4, a, 2), (5, a, None), (6, None, 1), (7, [0.0] * 64, 1)]
    rows += [(8, [None] + a[1:], 1), (9, [float("nan")] + a[1:], 1), (10, [], 1), (11, a[:5], 1), (None, a, 1)]
    rows += [(100 + i, v, 1) for i, v in enumerate(close)] + [(12, [float("inf")] + a[1:], 1), (2, a, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit("x"))
    found = embedding_itq.near_duplicates(frame).collect()
    assert len(found) == len(rows)
    by_id = {r.vec_id: (r.n_links, r.component_id) for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[None] == by_id[100] == (29, 1)
    assert all(by_id[i] == (0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12))
    assert embedding_itq.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("mean_cosine", [0.0, 0.5, 0.8, 0.9])
@pytest.mark.parametrize("size", [16, 32, 64])
def test_linked_vectors_meet_wherever_all_vectors_lie(mean_cosine, size):
    rng = np.random.default_rng(1)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    spread = unit(rng.normal(size=(3000, size)))
    vectors = unit(np.sqrt(mean_cosine) * unit(rng.normal(size=(1, size))) + np.sqrt(1 - mean_cosine) * spread)
    cosine = rng.uniform(0.93, 0.97, (3000, 1))
    across = rng.normal(size=vectors.shape)
    across = unit(across - (across * vectors).sum(1, keepdims=True) * vectors)
    partners = cosine * vectors + np.sqrt(1 - cosine**2) * across
    shift, turn = embedding_itq.fit_rotation(vectors)
    assert turn.shape == (size, embedding_itq.BITS)
    differ = ((vectors - shift) @ turn >= 0) != ((partners - shift) @ turn >= 0)
    assert embedding_itq._meet(differ).mean() > 0.95


# Archives.


def test_archives_are_read_back(spark, tmp_path):
    large, small = "<p>é</p>" * 50, "tiny"
    pages = [(5, "http://a/\r\nX: y", large), (3, "http://b", large), (9, None, large), (None, "u", large)]
    pages += [(1, "u", small), (2, "u", small), (4, "u", None), (6, "u", ""), (3, "http://b", large), (7, "u", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20)]
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, payload string")
    path = warc_revisits.write_archives(frame.select("page_id", "url", "html"), str(tmp_path / "w"), records=3)
    found = warc_revisits.resolved_records(warc_revisits.read_archives(spark, path)).collect()
    wanted = Counter()
    for page, _, html in pages:
        raw = (html or "").encode()
        twin = html == large and page != 3
        wanted[page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if twin else "response", 3 if twin else None] += 1
    rows = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found)
    assert rows == wanted
    ids = set()
    for file in Path(path).glob("*.gz"):
        with gzip.open(io.BytesIO(file.read_bytes())) as stream:
            for fields, block in warc_revisits.parse(stream):
                assert len(block) == int(fields["content-length"])
                assert fields["warc-date"] == warc_revisits.WRITTEN_AT
                ids.add(fields["warc-record-id"])
                assert ("warc-refers-to" in fields) == (fields["warc-type"] == "revisit")
    assert len(ids) == len(pages)
    empty = warc_revisits.write_archives(frame.select("page_id", "url", "html").limit(0), str(tmp_path / "e"))
    assert warc_revisits.read_archives(spark, empty).count() == 0


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 26])
def test_repeated_pages_by_brute_force(spark, tmp_path, monkeypatch, bits):
    """Many copies, payloads over the limit of an archive, repeated rows, and bitmaps that are too small."""
    import random

    monkeypatch.setattr(warc_revisits, "ARCHIVE_BYTES", 4000)
    rng = random.Random(bits)
    texts = ["x" * n for n in (0, 99, 100, 2500, 9000)] + [f"<p>{i}</p>" * 30 for i in range(40)]
    pages = [(rng.choice([None, *range(300)]), f"http://h/{i}", rng.choice(texts)) for i in range(400)]
    pages += [(1000 + i, "http://copy", texts[7]) for i in range(300)] + [(7, "http://same", texts[8])] * 5
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(6)
    path = warc_revisits.write_archives(frame, str(tmp_path / "w"), bits=bits)
    found = warc_revisits.resolved_records(warc_revisits.read_archives(spark, path)).collect()
    smallest = {}
    for page, _, html in pages:
        if len(html) >= 100 and page is not None:
            smallest[html] = min(page, smallest.get(html, page))
    wanted = Counter()
    for page, _, html in pages:
        first = smallest.get(html)
        twin = first is not None and first != page
        digest = hashlib.sha256(html.encode()).hexdigest()
        wanted[page, len(html), digest, "revisit" if twin else "response", first if twin else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == wanted
    ids, named = [], set()
    for file in Path(path).glob("*.gz"):
        with gzip.open(io.BytesIO(file.read_bytes())) as stream:
            own = list(warc_revisits.parse(stream))
        assert len(own) == 1 or sum(len(block) for _, block in own) < 4000 + 200 * len(own)
        ids += [fields["warc-record-id"] for fields, _ in own]
        named |= {fields["warc-refers-to"] for fields, _ in own if "warc-refers-to" in fields}
    assert len(ids) == len(set(ids)) == len(pages) and named <= set(ids)


# Shards.


@pytest.mark.parametrize("bits, n", [(2, 2), (3, 3), (2, 4), (4, 2)])
def test_the_curve_visits_each_cell_once_and_moves_one_step(spark, bits, n):
    cells = spark.range(1 << (bits * n))
    side = 1 << bits
    axes = [F.expr(f"(id div {side**i}) % {side}") for i in range(n)]
    rows = cells.select(*axes, hilbert_shards.hilbert_index(axes, bits).alias("at")).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(1 << (bits * n)))
    points = np.array([tuple(r)[:n] for r in rows])
    assert (np.abs(np.diff(points, axis=0)).sum(1) == 1).all()


def test_shards_of_odd_documents(odd_documents, monkeypatch):
    monkeypatch.setattr(hilbert_shards, "PIECE_ROWS", 5)
    monkeypatch.setattr(hilbert_shards, "COARSE_PIECES", 3)
    found = hilbert_shards.sharded(odd_documents)
    rows = found.collect()
    assert len(rows) == odd_documents.count()
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, count in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(count))
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in rows)
    import zlib

    for r in rows:
        raw = (r.text or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
    assert hilbert_shards.sharded(odd_documents.limit(0)).count() == 0
    few = hilbert_shards.sharded(odd_documents.limit(3)).collect()
    assert sorted(r.slot for r in few) == [0, 0, 0] and len({r.shard for r in few}) == 3


def _plain_curve(point, bits):
    """The place of a point on the Hilbert curve, by rotating the cube of each level in turn."""
    x, n = list(point), len(point)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                swap = (x[0] ^ x[i]) & (q - 1)
                x[0], x[i] = x[0] ^ swap, x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = 0
    for level in range(bits - 1, 0, -1):
        if x[-1] >> level & 1:
            flip ^= (1 << level) - 1
    digits = "".join(str((v ^ flip) >> level & 1) for level in range(bits - 1, -1, -1) for v in x)
    return int(digits, 2)


def _plain_axis(values, side):
    known = sorted({v for v in values if v is not None}, key=lambda v: v.encode())
    skip = 0
    if known:
        low, high = known[0].encode(), known[-1].encode()
        while skip < min(len(low), len(high)) and low[skip] == high[skip]:
            skip += 1
    code = lambda v: -1 if v is None else int.from_bytes(v.encode()[skip : skip + 2].ljust(2, b"\0"), "big")
    codes = sorted(map(code, values))
    place, top = {}, 0
    for c in sorted(set(codes)):
        before, rows = sum(x < c for x in codes), codes.count(c)
        top = max(top, min(side - 1, int(side * (before + rows / 2) / len(codes))))
        place[c] = top
    return [place[code(v)] for v in values]


def test_sharding_query_by_brute_force(spark, sf_medium):
    docs = table(spark, sf_medium, "documents").collect()
    side = 1 << hilbert_shards.BITS
    low, high = min(r.doc_id for r in docs), max(r.doc_id for r in docs)
    sources, langs = (_plain_axis([r[name] for r in docs], side) for name in ("source", "lang"))
    curve = {}
    for r, source, lang in zip(docs, sources, langs):
        size = len((r.text or "").encode()) + 1
        bytes_axis = min(side - 1, max(0, size.bit_length() - 1 - 3))
        ids_axis = min(side - 1, int((r.doc_id - low) / (high - low + 1) * side))
        curve[r.doc_id] = _plain_curve((source, lang, bytes_axis, ids_axis), hilbert_shards.BITS)
    rows = sorted(hilbert_shards.sharded(table(spark, sf_medium, "documents")).collect(), key=lambda r: (r.shard, r.slot))
    assert {r.doc_id: r.curve for r in rows} == curve
    assert [r.curve for r in rows] == sorted(curve.values())
    assert [r.shard for r in rows] == [i * 16 // len(docs) for i in range(len(docs))]
    query = {r.doc_id: (r.shard, r.slot) for r in queries.op10_hilbert_shards(spark, sf_medium).collect()}
    assert query == {r.doc_id: (r.shard, r.slot) for r in rows}


def test_filters_read_few_files(spark, sf_medium, tmp_path):
    """A reader skips files whose smallest and greatest value exclude its filter."""
    import pyarrow.parquet as pq

    docs = table(spark, sf_medium, "documents")
    total = docs.count()
    found = hilbert_shards.sharded(docs)
    hilbert_shards.in_files(found, total, rows=16).write.parquet(str(tmp_path / "curve"))
    files = sorted((tmp_path / "curve").glob("*.parquet"))
    found.orderBy(F.rand(3)).repartition(len(files)).write.parquet(str(tmp_path / "random"))

    def read(folder, column, low, high):
        hit = 0
        for file in (tmp_path / folder).glob("*.parquet"):
            data = pq.read_table(file, columns=[column]).column(0).to_pylist()
            hit += min(data) <= high and max(data) >= low
        return hit

    top = spark.read.parquet(str(tmp_path / "curve"))
    assert top.count() == total
    for file in files:
        data = pq.read_table(file).to_pylist()
        slots = [(r["shard"], r["slot"]) for r in data]
        assert slots == sorted(slots) and len({shard for shard, _ in slots}) == 1 and len(slots) <= 16
    low, high = (f(r.doc_id for r in docs.collect()) for f in (min, max))
    for column, a, b in (("source", "src3", "src3"), ("lang", "de", "de"), ("size", 1, 300), ("doc_id", low, low + (high - low) // 8)):
        by_curve, by_chance = read("curve", column, a, b), read("random", column, a, b)
        assert by_curve < 0.75 * by_chance, (column, by_curve, by_chance, len(files))


@pytest.mark.parametrize("full", [10**6, 50])
def test_rows_alike_are_in_many_pieces(spark, monkeypatch, full):
    monkeypatch.setattr(hilbert_shards, "PIECE_ROWS", 20)
    monkeypatch.setattr(hilbert_shards, "FULL_PIECE", full)
    kept = []
    store = hilbert_shards.stored
    monkeypatch.setattr(hilbert_shards, "stored", lambda frame: kept.append(store(frame)) or kept[-1])
    docs = spark.range(3000).selectExpr(
        "if(id % 3 = 0, null, id) as doc_id", "if(id % 3 = 0, null, 'text') as text", "'en' as lang", "'s' as source", "id as own"
    )
    rows = hilbert_shards.sharded(docs).collect()
    assert sorted(r.own for r in rows) == list(range(3000))
    assert sorted((r.shard, r.slot) for r in rows) == sorted((i * 16 // 3000, i - -(-(i * 16 // 3000) * 3000 // 16)) for i in range(3000))
    largest = max(r["rows"] for frame in kept if frame.columns == ["curve", "_piece", "rows"] for r in frame.collect()[-1:])
    most = max(r["rows"] for r in [f for f in kept if f.columns == ["curve", "_piece", "rows"]][-1].collect())
    assert largest and (most < 100) == (full == 50)


# The pipeline.


def test_stages_keep_the_columns_and_whole_documents(spark, sf_medium):
    documents = table(spark, sf_medium, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "mixing", "sharding",
    ]
    docs, ids = documents, {r.doc_id for r in documents.collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    folder = Path(queries.__file__)  # any stable name for the frames below
    assert folder.exists()
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, sf_medium)
        if name != "sharding":
            assert kept.columns == documents.columns
        kept = kept.cache()
        found = {r.doc_id for r in kept.collect()}
        assert found <= ids and found
        assert all(r.text == texts[r.doc_id] for r in kept.collect())
        if name == "quality":
            scores = {r.doc_id: r.predicted for r in queries.op1_quality_gam(spark, sf_medium).collect()}
            assert found == {i for i, p in scores.items() if p}
        elif name == "near_duplicates":
            groups = {r.doc_id: r.component_id for r in queries.simhash_ball.near_duplicates(docs).collect()}
            assert found == {i for i, c in groups.items() if i == c}
        elif name == "decontamination":
            bad = queries.op8_decontamination_wm(spark, sf_medium).where("contaminated")
            assert found == ids - {r.doc_id for r in bad.collect()}
        elif name == "mixing":
            words = lambda rows: sum(len(r.text.split()) for r in rows)
            assert words(kept.collect()) == pytest.approx(words(docs.collect()), rel=0.02)
        docs, ids = kept, found


def test_pipeline_runs_on_empty_tables(spark, sf_small, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, sf_small, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_run_leaves_only_its_last_stage_behind(spark, sf_medium):
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = {p for p in folder.rglob("*") if p.is_file()}
    last = corpus_pipeline.run(spark, sf_medium)
    left = {p for p in folder.rglob("*") if p.is_file()} - before
    assert left and all("sharding-" in str(p) for p in left)
    assert last.count() > 0


def test_only_the_shared_folder_is_deleted_from(spark, tmp_path):
    with pytest.raises(ValueError, match="shared folder"):
        discard(spark, str(tmp_path))
