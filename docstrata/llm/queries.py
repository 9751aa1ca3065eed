"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docstrata.llm import (
    centroids,
    chat,
    decontaminate,
    languages,
    lexical,
    licences,
    neardup,
    packing,
    quality,
    sharding,
    substrings,
    topk,
    warc,
)
from docstrata.llm.tables import Scratch, pick, reachable, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reachable(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query(
    "op2_decontaminate",
    r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
found AS (SELECT g.doc_id, g.i, g.n, v.item_id FROM grams g JOIN windows v ON g.n = v.n AND g.s = v.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
named AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY 1)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""",
)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


@query("op3_pack")
def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query(
    "op4_near_duplicates",
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
near AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS d, doc_id AS r FROM words UNION SELECT d, b FROM reach JOIN near ON r = a),
component AS (SELECT d AS doc_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN sizes USING (doc_id)
""",
)
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


@query(
    "op5_substrings",
    r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
first AS (SELECT h, min(doc_id) AS m FROM windows GROUP BY 1),
cut AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM windows JOIN first USING (h) WHERE m < doc_id),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM each ANTI JOIN cut USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM words LEFT JOIN kept k USING (doc_id)
""",
)
def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeated(pick(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    labels = pick(table(spark, sf_dir, "labels"), "doc_id", "quality")
    return quality.train(docs, labels.where(~quality.held_out()))


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    scored = quality.score_documents(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query(
    "op6_warc",
    r"""
WITH pages_ AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digits AS (
  SELECT page_id, html, octet_length(encode(html)) AS n, sha1(html) AS hex FROM pages_),
bits AS (
  SELECT page_id, html, n, hex, list_transform(range(0, 40), lambda i: ('0x' || substr(hex, i + 1, 1))::INT) AS q
  FROM digits),
coded AS (
  SELECT page_id, html, n, array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((q[(5 * k) // 4 + 1] * 16 + coalesce(q[(5 * k) // 4 + 2], 0)) // (1 << (3 - (5 * k) % 4))) % 32, 1)), '') AS code
  FROM bits),
last AS (SELECT html, max(page_id) AS m FROM pages_ GROUP BY 1)
SELECT page_id, n::BIGINT AS payload_bytes, code AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> m THEN m END AS refers_to
FROM coded JOIN last USING (html)
""",
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SHARDS = [f"shard-{n:02d}" for n in range(16)]


def _sharding_sql() -> str:
    size, count = sharding.TABLE_SIZE, len(SHARDS)
    names = ", ".join(f"({n}, '{s}')" for n, s in enumerate(SHARDS))
    number = "('0x' || substr(md5({}), 1, 15))::BIGINT"
    return f"""
WITH RECURSIVE names(n, shard) AS (VALUES {names}),
shards AS (
  SELECT n, shard, {number.format("shard || '/offset'")} % {size} AS a,
    {number.format("shard || '/skip'")} % {size - 1} + 1 AS skip FROM names),
orders AS (
  SELECT n, list((a + j * skip) % {size} ORDER BY j) AS slots
  FROM shards, range({size}) AS t(j) GROUP BY n),
fill AS (
  SELECT 0 AS turn, list_transform(range({size}), lambda x: -1) AS taken, NULL::BIGINT AS slot, NULL::BIGINT AS n
  UNION ALL
  SELECT turn + 1, taken[:s] || [n] || taken[s + 2:], s, n FROM (
    SELECT turn, taken, o.n, list_filter(o.slots, lambda x: taken[x + 1] < 0)[1] AS s
    FROM fill JOIN orders o ON o.n = turn % {count} WHERE turn < {size})),
lookup AS (SELECT slot, shard FROM fill JOIN names USING (n))
SELECT doc_id, slot, shard FROM (
  SELECT doc_id, {number.format("coalesce(doc_id::VARCHAR, '')")} % {size} AS slot FROM documents)
JOIN lookup USING (slot)
"""


@query("op7_sharding", _sharding_sql())
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(pick(table(spark, sf_dir, "documents"), "doc_id"), "doc_id", SHARDS)


@query(
    "op8_chat",
    r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
steps AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), '') AS before FROM rows_)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
    ELSE 1 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) END
    + length('### : ') + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) + length(' </turn>') + 1
  )::BIGINT AS formatted_chars,
  bool_and(CASE before WHEN 'user' THEN role = 'assistant' WHEN 'system' THEN role = 'user'
    WHEN 'assistant' THEN role = 'user' WHEN '' THEN role IN ('system', 'user') ELSE false END) AS valid
FROM steps GROUP BY conv_id
""",
)
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    segments = chat.format_conversations(conversations.unionByName(planted))
    written = Scratch(spark, "chat").write(segments)
    return chat.read_digests(written)


@query(
    "op9_topk",
    """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
)
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _licence_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def lines(text: str) -> str:
        source = quoted(licences.UPPER + licences.PUNCTUATION)
        target = quoted(licences.LOWER + " " * len(licences.PUNCTUATION))
        out = f"translate(coalesce({text}, ''), {source}, {target})"
        out = f"regexp_replace({out}, '{licences.COPYRIGHT_LINE}', '', 'g')"
        out = f"' ' || replace({out}, chr(10), ' ' || chr(10) || ' ') || ' '"
        out = f"regexp_replace({out}, ' +', '  ', 'g')"
        for other, kept in licences.SPELLINGS:
            out = f"replace({out}, ' {other.replace(' ', '  ')} ', ' {kept} ')"
        out = f"replace({out}, '  ', ' ')"
        trimmed = f"list_transform(string_split({out}, chr(10)), lambda l: trim(l))"
        return f"list_filter({trimmed}, lambda l: l <> '')"

    known = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in licences.known_texts())
    return f"""
WITH texts(licence, text) AS (VALUES {known}),
known AS (
  SELECT sha256(array_to_string(l, ' ')) AS digest, min(licence) AS licence
  FROM (SELECT licence, {lines("text")} AS l FROM texts) WHERE len(l) > 0 GROUP BY 1),
split AS (SELECT doc_id, {lines("text")} AS l FROM documents),
whole AS (
  SELECT doc_id, CASE WHEN len(l) > 0 THEN sha256(array_to_string(l, ' ')) END AS digest FROM split),
each AS (SELECT doc_id, sha256(line) AS digest FROM (SELECT doc_id, unnest(l) AS line FROM split)),
notices AS (
  SELECT doc_id, list_sort(list(DISTINCT licence)) AS n FROM each JOIN known USING (digest) GROUP BY 1)
SELECT doc_id, w.digest, licence, coalesce(array_to_string(n, ';'), '') AS notices
FROM whole w LEFT JOIN known USING (digest) LEFT JOIN notices USING (doc_id)
"""


@query("op10_licences", _licence_sql())
def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("notices", F.array_join("notices", ";"))


@query("op11_language")
def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    model = languages.train(docs, ~languages.held_out())
    found = languages.identify_languages(docs.drop("lang"), model)
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score")


@query(
    "op12_lexical",
    r"""
WITH documents_ AS (SELECT row_number() OVER () AS d, doc_id, text FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
terms AS (
  SELECT d, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents_),
asked AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM items),
sizes AS (SELECT d, count(*) AS n FROM terms GROUP BY 1),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM sizes),
held AS (SELECT d, doc_id, t, count(*) AS tf FROM terms WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM held GROUP BY 1), total),
impacts AS (
  SELECT d, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // l))) AS impact
  FROM held JOIN weights USING (t) JOIN sizes USING (d), total),
scores AS (
  SELECT i, item_id, d, doc_id, sum(impact)::BIGINT AS score FROM impacts JOIN asked USING (t) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
""",
)
def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _centroid_sql() -> str:
    k, rounds, scale, seed = centroids.CLUSTERS, centroids.ROUNDS, centroids.SCALE, centroids.SEED

    def nearest(i: int) -> str:
        return f"""
nearest_{i} AS MATERIALIZED (
  SELECT n, min(d * {k} + c) % {k} AS c, min(d * {k} + c) // {k} AS d FROM (
    SELECT n, c, sum((v.x - z.x) * (v.x - z.x))::HUGEINT AS d
    FROM component v JOIN centre_{i} z USING (p) GROUP BY 1, 2) GROUP BY 1)"""

    def moved(i: int) -> str:
        return f"""
centre_{i + 1} AS MATERIALIZED (
  SELECT c, p, coalesce(m.x, z.x) AS x FROM centre_{i} z LEFT JOIN (
    SELECT c, p, (s - ((s % m) + m) % m) // m AS x
    FROM (SELECT c, p, sum(x)::HUGEINT AS s, count(*) AS m FROM component JOIN nearest_{i} USING (n) GROUP BY 1, 2)
  ) m USING (c, p))"""

    steps = ",".join(nearest(i) + "," + moved(i) for i in range(rounds))
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
component AS MATERIALIZED (SELECT n, generate_subscripts(e, 1) AS p, unnest(e) AS x FROM kept),
centre_0 AS MATERIALIZED (
  SELECT c, generate_subscripts(e, 1) AS p, unnest(e) AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, e) - 1 AS c, e FROM kept) WHERE c < {k}),
{steps},{nearest(rounds)},
digests AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY p)) AS digest FROM centre_{rounds} GROUP BY 1)
SELECT vec_id, c::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, digest AS centroid_sha256
FROM kept JOIN nearest_{rounds} USING (n) JOIN digests USING (c)
"""


@query("op13_centroids", _centroid_sql())
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))
