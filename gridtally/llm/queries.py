"""The registered queries of the corpus operators, and the SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm import decontamination_wm as wm
from gridtally.llm import chat_prefix, embedding_itq, filter_audit, hilbert_shards, periodic_runs, pii_semicrf
from gridtally.llm import quality_gam, simhash_ball, source_schedule, token_prefix, toxicity_fm, warc_revisits
from gridtally.llm.common import WORD, remainder, table

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def _held_out(divisor: int, value: int):
    return F.coalesce(remainder(F.col("doc_id"), divisor) == value, F.lit(False))


def quality_labels(labels: DataFrame) -> DataFrame:
    """The labels a quality model may learn from."""
    return labels.where(remainder(F.col("doc_id"), 4) != 2).select("doc_id", F.col("quality").alias("label"))


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality_gam.fit_on(docs, quality_labels(table(spark, sf_dir, "labels")))
    scored = docs.select("doc_id", quality_gam.score(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id", _held_out(4, 2).alias("held_out"), "score",
        (F.col("score") >= quality_gam.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_pii_semicrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    field = pii_semicrf.fit_on(docs)
    found = docs.select("doc_id", pii_semicrf.find_spans(F.col("text"), field).alias("found"))
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter(F.col("found.base"), lambda s: s["kind"] == kind))
    counts = [count(kind).cast("long").alias(f"n_{kind}") for kind in pii_semicrf.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(text(F.col("found.base")), 256).alias("base_sha256"),
        text(F.col("found.all")).alias("spans"),
    )


def op3_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) != 0)
    machine = toxicity_fm.fit_on(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    scored = docs.select("doc_id", toxicity_fm.score(F.col("text"), machine).alias("score"))
    return scored.select(
        "doc_id", _held_out(5, 0).alias("held_out"), "score",
        (F.col("score") >= toxicity_fm.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    groups = simhash_ball.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select(
        "doc_id", simhash_ball.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op5_token_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, and how much of it fits the limit."""
    import public_tokenizers

    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        vocabulary = file.read()
    docs = table(spark, sf_dir, "documents")
    counted = docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_prefix.token_counts(F.col("text"), vocabulary, TOKEN_LIMIT).alias("c"),
    )
    return counted.select(
        "doc_id", "n_bytes", "c.n_tokens", (F.col("c.n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        F.col("c.cut").alias("cut_characters"),
    )


def op6_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix reads."""
    mix = source_schedule.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op7_embedding_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors."""
    found = embedding_itq.near_duplicates(table(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return found.withColumn("kept", kept)


def op8_decontamination_wm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = wm.find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    hit = found.select("doc_id", "n_words", wm.hit_words(F.col("runs")).alias("n_hit"), "items")
    return hit.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        wm.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages hold, read back."""
    path = warc_revisits.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    records = warc_revisits.resolved_records(warc_revisits.read_archives(spark, path))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return hilbert_shards.sharded(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in every tenth document by its id's checksum the words repeat from some word on."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    tenth = F.coalesce(checksum % 10 == 0, F.lit(False))
    words = F.when(tenth, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    split = docs.select("doc_id", "text", words.alias("words"), F.floor(checksum / 10).alias("g"))
    sized = split.select("*", F.size("words").alias("n"))
    begun = sized.select("*", F.expr("int(g % nullif(n, 0))").alias("a"))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    known = begun.select("*", period.alias("p"), (F.col("n") - F.col("a")).alias("rest"))
    stretch = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(F.col("rest") / F.col("p")).cast("int"))
    repeated = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(F.flatten(stretch), F.lit(1), F.col("rest")))
    return known.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document."""
    docs = planted_repeats(table(spark, sf_dir, "documents"))
    found = docs.select("doc_id", periodic_runs.find_runs(F.col("text")).alias("found"))
    runs = F.col("found.runs")
    best = found.select("*", periodic_runs.strongest(runs).alias("best"))
    line = lambda r: F.concat(F.concat_ws(",", *(r[x].cast("string") for x in ("start", "length", "period"))), F.lit("\n"))
    return best.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(runs, line), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed"), 256).alias("collapsed_sha256"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each language in each of their orders."""
    failed = filter_audit.failures(table(spark, sf_dir, "documents"))
    counts = filter_audit.mask_counts(failed, table(spark, sf_dir, "labels"))
    return filter_audit.interaction_audit(spark, counts).drop("filter")


def op13_chat_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples of all conversations, read back."""
    added = "</s>[INST] ok [/INST]"
    rows = F.array(*(F.struct(F.lit(t).alias("turn"), F.lit(r).alias("role")) for t, r in enumerate(("user", "assistant"))))
    extra = spark.range(1).select(F.explode(rows).alias("row"))
    extra = extra.select(F.lit(-1).cast("long").alias("conv_id"), "row.turn", "row.role", F.lit(added).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat_prefix.read_back(chat_prefix.expand(turns), in_order=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's rows."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_gam, op2_pii_semicrf, op3_toxicity_fm, op4_simhash_ball, op5_token_prefix,
        op6_source_schedule, op7_embedding_itq, op8_decontamination_wm, op9_warc_revisits,
        op10_hilbert_shards, op11_periodic_runs, op12_filter_audit, op13_chat_prefix, pipeline,
    )
}

_MIX = r"""
WITH sizes AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sizes GROUP BY source
), levels AS (
  SELECT source, source_size, weight, 3 * source_size AS most,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM totals
  WINDOW before AS (ORDER BY 3 * source_size::DOUBLE / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
    least(most::DOUBLE, weight * (SELECT max(level) FROM levels WHERE level * weight <= most)) AS target
  FROM levels
), placed AS (
  SELECT doc_id, source, size,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, '')),
      doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sizes
), goals AS (SELECT *, round(target)::BIGINT AS goal FROM targets)
SELECT doc_id, size, source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE
    (goal // source_size) * size
      + greatest(0, least(start + size, goal % source_size) - start)
  END::BIGINT AS taken
FROM placed JOIN goals ON placed.source IS NOT DISTINCT FROM goals.source
"""

_LINKS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v,
    label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.usable AND b.usable AND list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id,
  vec_id = component_id AS kept
FROM vectors JOIN lowest ON vec_id = a
"""

_WINDOWS = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT DISTINCT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), strings AS (
  SELECT DISTINCT item, least(13, len(w)) AS width,
    array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS string
  FROM items, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0
), places AS (
  SELECT doc_id, i, width, array_to_string(w[i : i + width - 1], ' ') AS string
  FROM lowered, (SELECT DISTINCT width FROM strings), unnest(range(1, len(w) - width + 2)) AS t(i)
), found AS (SELECT doc_id, i, places.width, item FROM places JOIN strings USING (width, string)),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM found, unnest(range(i, i + width)) AS t(j) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM found GROUP BY doc_id
)
SELECT lowered.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM lowered LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

_RECORDS = """
WITH records AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS original FROM records WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN original IS NULL OR original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM records LEFT JOIN firsts USING (payload_digest)
"""

_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
), said AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, list_filter([
    CASE WHEN len(w) < 200 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
    CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
    CASE WHEN first_id < texts.doc_id THEN 'E' END], lambda x: x IS NOT NULL) AS fails
  FROM texts LEFT JOIN said ON texts.doc_id = said.doc_id
), kinds AS (
  SELECT part, fails, good, toxic, count(*) AS n FROM failing GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step:step] AS filter, filter_order[1:step - 1] AS earlier
  FROM orders, range(1, 6) AS t(step)
), told AS (
  SELECT part, filter_order, step, filter, n, good, toxic,
    len(list_filter(fails, lambda x: contains(earlier, x))) > 0 AS gone,
    list_contains(fails, filter) AS hit, len(fails) = 1 AS alone
  FROM kinds, steps
), summed AS (
  SELECT part, filter_order, step, filter,
    sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN gone AND hit THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN hit AND alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN NOT gone AND hit AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT gone AND hit AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM told GROUP BY ALL
)
SELECT * EXCLUDE (filter), (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM summed
"""

_EXAMPLES = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    regexp_replace(regexp_replace(text, '<(~*/?s>)', '<~\1', 'g'), '\[(~*/?(?:INST|ROLE)\])', '[~\1', 'g') AS body,
    regexp_replace(regexp_replace(role, '<(~*/?s>)', '<~\1', 'g'), '\[(~*/?(?:INST|ROLE)\])', '[~\1', 'g') AS name
  FROM turns
), sized AS (
  SELECT *, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(CASE role WHEN 'user' THEN 16 WHEN 'assistant' THEN 4 ELSE 17 + len(name) END + len(body))
      OVER (PARTITION BY conv_id ORDER BY place) AS ends
  FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  count(*) FILTER (role = 'assistant' OR place = n) AS n_examples,
  (sum(ends) FILTER (role = 'assistant' OR place = n))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLE_SQL: dict[str, str] = {
    "op6_source_schedule": _MIX,
    "op7_embedding_itq": _LINKS,
    "op8_decontamination_wm": _WINDOWS,
    "op9_warc_revisits": _RECORDS,
    "op12_filter_audit": _AUDIT,
    "op13_chat_prefix": _EXAMPLES,
}
