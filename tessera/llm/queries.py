"""The registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, chat_trees, exact_dedup, fingerprints, line_rules, merkle, ngram_join, packing, quality, secrets, spelling, toxicity, url_lists
from tessera.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def packed_pieces(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", packing.ids_crc32().alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "cost")


@register("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document, learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold() != 2)
    out = toxicity.severity(docs, model)
    return out.select("doc_id", (fold() == 2).alias("held_out"), "score", "expected_severity", "grade", (F.col("score") >= 0.5).alias("toxic"))


#: Fetch days and the list's history, from the pages: the tables have neither. A page is
#: fetched on a day that its id gives; every host, the domain above it and every URL are added,
#: removed and, where that falls in, added again on days that their first page's id gives.
PAGES_SQL = r"""
    WITH links AS (
      SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 7919 % 730 AS INTEGER) AS fetched_on,
             regexp_replace(lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@|:[0-9]*$', '')), '[.]$', '') AS host,
             regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
      FROM pages),
    keys AS (
      SELECT 'host' AS kind, host AS key, min(page_id) AS first FROM links WHERE host <> '' GROUP BY host
      UNION ALL
      SELECT 'domain', regexp_replace(host, '^[^.]*[.]', ''), min(page_id) FROM links WHERE host LIKE '%.%.%' GROUP BY 2
      UNION ALL
      SELECT 'url', host || CASE WHEN path = '' THEN '/' ELSE path END, min(page_id) FROM links WHERE host <> '' GROUP BY 2),
    days AS (
      SELECT kind, key, first * 37 % 600 AS a, first * 37 % 600 + 20 + first % 90 AS b, first * 37 % 600 + 150 + first % 300 AS c FROM keys),
    entries AS (
      SELECT kind, key, DATE '2024-01-01' + CAST(a AS INTEGER) AS day, TRUE AS added FROM days
      UNION ALL SELECT kind, key, DATE '2024-01-01' + CAST(b AS INTEGER), FALSE FROM days
      UNION ALL SELECT kind, key, DATE '2024-01-01' + CAST(c AS INTEGER), TRUE FROM days WHERE c < 730)
"""
OP2_SQL = (
    PAGES_SQL
    + r""",
    spells AS (
      SELECT kind, key, day AS since, added,
             coalesce(lead(day) OVER (PARTITION BY kind, key ORDER BY day), DATE '9999-12-31') AS until FROM entries),
    asked AS (
      SELECT page_id, fetched_on, 'url' AS kind, host || CASE WHEN path = '' THEN '/' ELSE path END AS key FROM links WHERE host <> ''
      UNION ALL SELECT page_id, fetched_on, 'host', host FROM links WHERE host <> ''
      UNION ALL
      SELECT page_id, fetched_on, 'domain', array_to_string(string_split(host, '.')[k:], '.')
      FROM (SELECT *, unnest(range(1, len(string_split(host, '.')))) AS k FROM links WHERE host <> '')),
    hits AS (
      SELECT a.page_id, s.kind, s.key, s.since,
             row_number() OVER (PARTITION BY a.page_id ORDER BY list_position(['domain', 'host', 'url'], s.kind) DESC, length(s.key) DESC) AS n
      FROM asked a JOIN spells s ON a.kind = s.kind AND a.key = s.key AND s.added AND s.since <= a.fetched_on AND a.fetched_on < s.until)
    SELECT l.page_id, CAST(l.fetched_on AS VARCHAR) AS fetched_on, h.page_id IS NOT NULL AS blocked, coalesce(c.n, 0) AS n_active,
           h.kind AS matched_kind, h.key AS matched_key, CAST(h.since AS VARCHAR) AS active_since
    FROM links l LEFT JOIN hits h ON l.page_id = h.page_id AND h.n = 1
    LEFT JOIN (SELECT page_id, count(*) AS n FROM hits GROUP BY page_id) c ON l.page_id = c.page_id
    """
)


def list_entries(links: DataFrame) -> DataFrame:
    """The list's history, see PAGES_SQL."""
    host, url = F.col("host"), F.col("url")
    first = F.min("page_id").alias("first")
    hosts = links.where("host <> ''").groupBy(F.lit("host").alias("kind"), host.alias("key")).agg(first)
    above = links.where("host like '%.%.%'").groupBy(F.lit("domain").alias("kind"), F.regexp_replace(host, "^[^.]*[.]", "").alias("key")).agg(first)
    urls = links.where("host <> ''").groupBy(F.lit("url").alias("kind"), url_lists.url_key(url).alias("key")).agg(first)
    at = F.expr("array(first * 37 % 600, first * 37 % 600 + 20 + first % 90, first * 37 % 600 + 150 + first % 300)")
    dated = hosts.unionByName(above).unionByName(urls).select("kind", "key", F.posexplode(at).alias("i", "at")).where("i < 2 or at < 730")
    return dated.select("kind", "key", F.expr("date_add(date'2024-01-01', cast(at as int))").alias("day"), F.expr("i <> 1").alias("added"))


@register("op2_url_lists", OP2_SQL)
def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries active on its fetch day."""
    day = F.expr("date_add(date'2024-01-01', cast(page_id * 7919 % 730 as int))")
    links = table(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetched_on"), url_lists.host_of(F.col("url")).alias("host"))
    out = url_lists.evaluated(links, url_lists.intervals(list_entries(links)))
    return out.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "active_since")})


@register("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, packed into sequences of 2048 ids."""
    return packed_pieces(packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), kept_units=700_000))


@register(
    "op4_chat_trees",
    r"""
    WITH m AS (
      SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
      UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x)) AS turns_sha256,
           CAST(sum(CASE WHEN r = 'assistant' THEN length(x) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(x, '' ORDER BY turn, r, x) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length('[TURN ]</s>') + 1 + length(regexp_replace(r, '[\\\[\]<]', '..', 'g')) + length(regexp_replace(x, '[\\\[\]<]', '..', 'g'))) AS BIGINT) AS formatted_chars
    FROM m GROUP BY conv_id
    """,
)
def op4_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and conversation -7 formatted, and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    return chat_trees.digests(chat_trees.conversations(rows.unionByName(more)), "conv_id")


@register(
    "op5_ngram_join",
    r"""
    WITH RECURSIVE split AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                     ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
      FROM split),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
      SELECT a.doc_id AS x, b.doc_id AS y
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
      JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING 100 * count(*) >= 80 * (m.n + n.n - count(*))),
    reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.y, d.doc_id)) AS component_id
    FROM split d LEFT JOIN sizes s ON s.doc_id = d.doc_id
    LEFT JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) r ON r.x = d.doc_id
    """,
)
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near copies of every document."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@register("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt outside the held-out fold."""
    out = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold() != 2)
    return out.select("doc_id", (fold() == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op7_line_rules")
def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line field's verdict on every document."""
    docs = table(spark, sf_dir, "documents")
    return line_rules.line_rules(docs, line_rules.learn(docs, table(spark, sf_dir, "labels"), fold() != 2))


@register("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    rows = secrets.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    return rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"), count(3).alias("n_random"),
    )


@register("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again from its ids."""
    ids = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path())
    ids = ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), "ids",
    )
    out = bpe.decode(ids, tokenizer_path(), keep=("doc_id", "n_tokens", "ids_sha256"))
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@register(
    "op10_exact_dedup",
    r"""
    WITH normal AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
    FROM normal WINDOW same AS (PARTITION BY t)
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


#: crc32 of a list of byte values: its table, then one step per byte.
CRC_SQL = "crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS t)"


def crc32_sql(data: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295], {data}), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295)"


DECIMAL_SQL = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))"
#: Both trees level by level, then each row's way up: siblings collected, the digest folded.
OP11_SQL = rf"""
    WITH RECURSIVE {CRC_SQL},
    docs AS (
      SELECT *, coalesce('=' || source, '') AS g, {crc32_sql(DECIMAL_SQL)} % 5 = 0 AS tampered,
             coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
             || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
      FROM documents, crc),
    leaves AS (
      SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
             CASE WHEN tampered THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS now,
             row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n
      FROM docs),
    tree AS (
      SELECT 0 AS lvl, g, pos, n, h FROM leaves
      UNION ALL
      SELECT lvl + 1, g, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY lvl, g, pos // 16),
    subroots AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
    top AS (
      SELECT 0 AS lvl, pos, n, h FROM subroots
      UNION ALL
      SELECT lvl + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 16),
    runs AS (SELECT lvl, g, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM tree WHERE n > 1 GROUP BY ALL),
    top_runs AS (SELECT lvl, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM top WHERE n > 1 GROUP BY ALL),
    low_walk AS (
      SELECT doc_id, g, 0 AS lvl, pos, n, now AS h, '' AS proof FROM leaves
      UNION ALL
      SELECT doc_id, w.g, w.lvl + 1, pos // 16, (n + 15) // 16,
             sha256(array_to_string(hs[:pos % 16], '') || h || array_to_string(hs[pos % 16 + 2:], '')),
             proof || array_to_string(hs[:pos % 16], '') || array_to_string(hs[pos % 16 + 2:], '')
      FROM low_walk w JOIN runs r ON r.g = w.g AND r.lvl = w.lvl AND r.run = w.pos // 16 WHERE n > 1),
    top_walk AS (
      SELECT doc_id, 0 AS lvl, s.pos, s.n, w.h, proof FROM low_walk w JOIN subroots s ON s.g = w.g WHERE w.n = 1
      UNION ALL
      SELECT doc_id, w.lvl + 1, pos // 16, (n + 15) // 16,
             sha256(array_to_string(hs[:pos % 16], '') || h || array_to_string(hs[pos % 16 + 2:], '')),
             proof || array_to_string(hs[:pos % 16], '') || array_to_string(hs[pos % 16 + 2:], '')
      FROM top_walk w JOIN top_runs r ON r.lvl = w.lvl AND r.run = w.pos // 16 WHERE n > 1)
    SELECT l.doc_id, l.h AS leaf, s.h AS subroot, t.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = t.h AS verified
    FROM leaves l JOIN subroots s ON s.g = l.g JOIN top_walk w ON w.doc_id = l.doc_id AND w.n = 1 JOIN top t ON t.n = 1
"""


@register("op11_merkle_manifest", OP11_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof in the manifest, and whether a tampered one still gives the root."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.tamper_check(table(spark, sf_dir, "documents"), tampered, lower)


@register("op12_fingerprints")
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against its edited text's and the next document's."""
    return fingerprints.edits_compared(table(spark, sf_dir, "documents"))


UTF8_SQL = "flatten(list_transform(string_split(r, ''), lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] ELSE [192 + CAST(ord(x) AS BIGINT) // 64, 128 + CAST(ord(x) AS BIGINT) % 64] END))"
OP13_SQL = rf"""
    WITH RECURSIVE {CRC_SQL},
    runs AS (
      SELECT doc_id, r, count(*) AS c
      FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents)
      GROUP BY doc_id, r),
    hashed AS (SELECT r, c, length(r) AS l, {crc32_sql(f"list_concat({DECIMAL_SQL}, [58], {UTF8_SQL})")} AS h FROM runs, crc),
    cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % l) || substr(r, h % l + 2) ELSE r END AS word, c FROM hashed),
    words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
    skips AS (SELECT DISTINCT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
    near AS (
      SELECT x.word, y.word AS other, y.n AS m FROM skips x JOIN skips y ON x.a = y.a AND x.b = y.b AND x.word <> y.word AND length(x.word) = length(y.word)
      UNION SELECT s.word, w.word, w.n FROM skips s JOIN words w ON w.word = s.a || s.b
      UNION SELECT w.word, s.word, s.n FROM skips s JOIN words w ON w.word = s.a || s.b),
    sorted AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM near),
    forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 2 * w.n THEN b.other END AS form, CASE WHEN b.m >= 2 * w.n THEN b.m END AS form_n
              FROM words w LEFT JOIN sorted b ON b.word = w.word AND b.k = 1),
    walk AS (SELECT word, coalesce(form, word) AS spot FROM forms UNION SELECT k.word, f.form FROM walk k JOIN forms f ON f.word = k.spot AND f.form IS NOT NULL)
    SELECT f.word, f.form, k.spot AS root, f.n, f.n_near, f.form_n
    FROM forms f JOIN walk k ON k.word = f.word JOIN forms e ON e.word = k.spot AND e.form IS NULL
"""


@register("op13_spelling_variants", OP13_SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the common spelling that it is a variant of."""
    return spelling.spelling_forms(spelling.word_counts(table(spark, sf_dir, "documents"), damage=97))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
