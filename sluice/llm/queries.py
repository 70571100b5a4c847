"""One query per operator over its whole table, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import audit, divergence, infill, jaccard, language, leaks, licences, packing, perplexity, records, ring, spans, warc
from sluice.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: CRC-32 of the UTF-8 bytes of ``text`` over the CTE ``crc_table(tb)``
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_concat([k], range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY k) AS tb
  FROM range(256) t(k))"""
CRC_TEXT = """xor(list_reduce(list_concat([4294967295::BIGINT],
  list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
  lambda c, b: xor(c >> 8, tb[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT"""

SHARDS, POINTS = 8, 128


@query
def op10_consistent_ring(spark: SparkSession, folder: str) -> DataFrame:
    """All documents on a ring with bounded loads: row counts differ by one at most."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = ring.shard_rows(docs, "doc_id", SHARDS, POINTS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _ring_sql(shards: int, points: int) -> str:
    """The walk round by round on rows: offers in ring order, then on to the next open shard."""
    rounds = []
    for k in range(shards):
        rounds.append(f"""offer{k} AS (
  SELECT r.*, p.shard, row_number() OVER (PARTITION BY p.shard ORDER BY home, wrapped, r.pos, doc_id, size, text_crc32) AS place
  FROM rest{k} r JOIN points p ON p.n = r.ptr),
placed{k} AS (SELECT o.*, u.used + place - 1 AS slot FROM offer{k} o JOIN used{k} u USING (shard) WHERE u.used + place <= u.room),
used{k + 1} AS (
  SELECT u.shard, u.room, u.used + coalesce(c, 0) AS used FROM used{k} u
  LEFT JOIN (SELECT shard, count(*) AS c FROM placed{k} GROUP BY shard) USING (shard)),
open{k + 1} AS (SELECT n FROM points JOIN used{k + 1} USING (shard) WHERE used < room),
next{k + 1} AS (
  SELECT p.n, (p.n + min((o.n - p.n + total) % total)) % total AS ptr
  FROM points p, open{k + 1} o, (SELECT count(*) AS total FROM points) GROUP BY p.n, total),
rest{k + 1} AS (
  SELECT o.doc_id, o.size, o.text_crc32, o.pos, o.home, o.wrapped, x.ptr FROM offer{k} o
  JOIN used{k} u USING (shard) JOIN next{k + 1} x ON x.n = o.ptr WHERE u.used + place > u.room)""")
    placed = "\nUNION ALL ".join(
        f"SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard, slot::BIGINT AS slot, NULL::INT AS grown_shard FROM placed{k}"
        for k in range(shards)
    )
    return f"""WITH {CRC_TABLE},
raw AS (
  SELECT pos, min(shard) AS shard FROM (
    SELECT s AS shard, ('0x' || substr(md5('shard-' || s || '-' || k), 1, 8))::BIGINT AS pos FROM range({shards}) a(s), range({points}) b(k))
  GROUP BY pos),
points AS (SELECT row_number() OVER (ORDER BY pos) - 1 AS n, pos, shard FROM raw),
docs AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, {CRC_TEXT} AS text_crc32,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS pos FROM documents, crc_table),
homes AS (
  SELECT d.*, coalesce((SELECT min(n) FROM points p WHERE p.pos >= d.pos), 0) AS home,
    d.pos <= (SELECT min(pos) FROM points) AS wrapped FROM docs d),
rest0 AS (SELECT *, home AS ptr FROM homes),
used0 AS (
  SELECT s AS shard, 0 AS used, (SELECT count(*) FROM docs) // {shards} + (s < (SELECT count(*) FROM docs) % {shards})::INT AS room
  FROM range({shards}) a(s)),
{", ".join(rounds)}
{placed}"""


SQL["op10_consistent_ring"] = _ring_sql(SHARDS, POINTS)


@query
def op7_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counting rules and distances to the language's distributions, for every document."""
    return divergence.judge(table(spark, folder, "documents"))


@query
def op5_naive_bayes(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the four fifths that are not held out."""
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    model = language.train(docs.filter(~held_out & F.col("lang").isNotNull()))
    return language.identify(docs, model, "doc_id", held_out)


@query
def op9_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the sentences that repeat an earlier run of sentences."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spans.remove_repeats(docs)


@query
def op8_edit_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item's best occurrence in every document, within the error budget."""
    return leaks.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed public vocabulary files lie; the operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op6_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


@query
def op2_warc_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives, and its record read back by byte range."""
    target = scratch_path(spark, "warc")
    index = warc.write_archives(table(spark, folder, "pages"), target)
    records = warc.read_records(index, target, payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op2_warc_ranges"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS response FROM p WHERE payload_bytes >= 100 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > response THEN response END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)"""


@query
def op4_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The licence of every document, taken as a file ``source/lang/doc_id.txt``."""
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licences.scan(table(spark, folder, "documents").withColumn("path", path))


@query
def op3_parity_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Documents linked by a Jaccard similarity of 0.9 or more on 3-word shingles."""
    return jaccard.jaccard_classes(table(spark, folder, "documents"), jaccard.Similar(words=3, percent=90))


#: all pairs with a common shingle; tables small enough for DuckDB
SQL["op3_parity_sketch"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common >= 90 * (p.n + q.n - common)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(y) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id, n"""


@query
def op1_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity of every document under a model of trusted text, and whether it is kept."""
    return perplexity.judge(table(spark, folder, "documents"))


@query
def op11_length_delimited(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents written as framed records, and every record read back."""
    target = scratch_path(spark, "records")
    index = records.write_records(table(spark, folder, "documents"), target, tokenizer_path())
    return records.read_records(index, target, ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op12_term_transducer(spark: SparkSession, folder: str) -> DataFrame:
    """Divergence of all sources of a language from each other, and the terms that make them differ from it."""
    return audit.divergence_audit(table(spark, folder, "documents"))


SQL["op12_term_transducer"] = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (
  SELECT lang, source, term, n, (1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v)) AS p
  FROM cells JOIN v USING (lang)),
q AS (
  SELECT lang, term, (1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang) + v)) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL) JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a
  JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM listed)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""


@query
def op13_rank_index(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as prefix, suffix and middle, and whether the text comes back."""
    made = infill.fill_in_middle(table(spark, folder, "documents"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(infill.restored(F.col("output"), F.col("form")), 256)}
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *[c.alias(k) for k, c in digests.items()])


SQL["op13_rank_index"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
l AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^
]*
|[^
]+') AS u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a,
    ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b, ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 AS spm FROM d),
p AS (
  SELECT doc_id, n, t, spm, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain,
    array_to_string(u[1:least(a, b)], '') AS prefix, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
    array_to_string(u[greatest(a, b) + 1:n], '') AS suffix FROM l)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN length(prefix) END AS prefix_chars, CASE WHEN NOT plain THEN length(middle) END AS middle_chars,
  sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p"""
