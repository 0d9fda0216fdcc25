"""The registered ``opN_<name>`` queries: each applies its operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from . import (extraction, hard_negatives, minhash, mixing, packing, quality, quality_sql, sharding, simhash, suffix,
               topk_search, toxicity, warc, whitening)
from .base import table
from .registry import ORACLE_SQL, QUERIES, register  # noqa: F401


# SHA-1 hex to bare base32: every five hex digits are four letters
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
largest AS (SELECT body, max(page_id) AS page FROM p GROUP BY body)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(sha1(body), (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT,
         1)), '') AS payload_digest,
       CASE WHEN page_id < page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < page THEN page END AS refers_to
FROM p JOIN largest USING (body)"""


@register("op1_warc", WARC_SQL)
def op1(spark, sf_dir):
    return warc.archived(table(spark, sf_dir, "pages"))


def _level(table_, parents, cap="cap"):
    """One level of the budget tree in SQL: the node's own budget."""
    by = f"PARTITION BY {parents}" if parents else ""
    return f"""
      SELECT * EXCLUDE (budget, before, above, filled, held, open_weight),
             CASE WHEN filled THEN cap
                  ELSE ((weight * (budget - held)) // open_weight)::BIGINT END AS budget
      FROM (SELECT *, sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({by}) AS held,
                   sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({by}) AS open_weight
            FROM (SELECT *, cap::HUGEINT * above <= weight::HUGEINT * (budget - before) AS filled
                  FROM (SELECT *, coalesce(sum(cap) OVER ({by} ORDER BY cap / weight, cap
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                               coalesce(sum(weight) OVER ({by} ORDER BY cap / weight, cap
                                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS above
                        FROM ({table_}))))"""


def _weight(level):
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mixing.WEIGHTS.get(level, {}).items())
    return f"CASE {level} {cases} ELSE 1 END" if cases else "1"


MIXING_SQL = f"""
WITH rows_ AS (
  SELECT doc_id,
         coalesce('domain' || (try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4), 'none') AS domain,
         coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens,
                  (sum(tokens) * {mixing.MAX_EPOCHS})::BIGINT AS cap FROM rows_ GROUP BY ALL),
root AS (SELECT least(sum(tokens) * {mixing.TARGET[0]} // {mixing.TARGET[1]}, sum(cap))::BIGINT AS budget
         FROM leaves),
d AS ({_level(f"SELECT domain, sum(cap)::BIGINT AS cap, {_weight('domain')} AS weight, any_value(budget) AS budget FROM leaves, root GROUP BY domain", "")}),
l AS ({_level(f"SELECT domain, lang, sum(leaves.cap)::BIGINT AS cap, {_weight('lang')} AS weight, any_value(d.budget) AS budget FROM leaves JOIN d USING (domain) GROUP BY domain, lang", "domain")}),
s AS ({_level(f"SELECT domain, lang, source, leaves.cap, leaves.tokens, {_weight('source')} AS weight, l.budget FROM leaves JOIN l USING (domain, lang)", "domain, lang")}),
plan AS (SELECT domain, lang, source,
                CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole_epochs,
                CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM s),
keyed AS (SELECT rows_.*, whole_epochs, rest,
                 md5('{mixing.SEED}:' || whole_epochs || ':' || coalesce(doc_id::VARCHAR, 'null')) AS key
          FROM rows_ JOIN plan USING (domain, lang, source)),
placed AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key
                      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE TIES), tokens) - tokens AS before
           FROM keyed)
SELECT doc_id, domain, lang, source, epoch::BIGINT AS epoch, tokens, tokens AS taken
FROM placed, range(whole_epochs) t(epoch)
UNION ALL
SELECT doc_id, domain, lang, source, whole_epochs::BIGINT AS epoch, tokens,
       least(tokens, rest - before)::BIGINT AS taken
FROM placed WHERE before < rest"""


@register("op2_extraction")
def op2(spark, sf_dir):
    return extraction.extracted(table(spark, sf_dir, "pages"))


# Every string of 50 bytes as 100 hex digits; a byte goes if a marked string
# starts at most 49 bytes before it
SUFFIX_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(greatest(len(h) // 2 - {suffix.LENGTH - 1}, 0))) AS p FROM d),
strings AS (SELECT doc_id, p, hash(substr(h, (2 * p + 1)::INT, {2 * suffix.LENGTH})) AS a,
                   md5_number_lower(substr(h, (2 * p + 1)::INT, {2 * suffix.LENGTH})) AS b FROM starts),
marked AS (SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY a, b) AS first FROM strings)
           WHERE first < doc_id),
bytes AS (SELECT doc_id, unnest(range(len(h) // 2)) AS q, unnest(regexp_extract_all(h, '..')) AS x FROM d),
judged AS (SELECT doc_id, q, x, coalesce(q - max(p) OVER (PARTITION BY doc_id ORDER BY q
                                 ROWS BETWEEN {suffix.LENGTH - 1} PRECEDING AND CURRENT ROW) < {suffix.LENGTH}, FALSE) AS gone
           FROM (SELECT bytes.*, marked.p FROM bytes LEFT JOIN marked
                 ON bytes.doc_id = marked.doc_id AND bytes.q = marked.p)),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY q), FALSE) AS opens FROM judged)
SELECT d.doc_id, coalesce(count(q), 0)::BIGINT AS n_bytes, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
       count(*) FILTER (WHERE opens)::BIGINT AS n_spans,
       sha256(unhex(coalesce(string_agg(x, '' ORDER BY q) FILTER (WHERE NOT gone), ''))) AS kept_sha256
FROM d LEFT JOIN edges ON d.doc_id = edges.doc_id GROUP BY d.doc_id"""


@register("op3_suffix_dedup", SUFFIX_SQL)
def op3(spark, sf_dir):
    return suffix.deduplicated(table(spark, sf_dir, "documents"))


@register("op4_mixing", MIXING_SQL)
def op4(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


# CRC-32 byte by byte with the table of its polynomial; rendezvous by the
# smallest -ln(u), u from 52 bits of an MD5
_STEP = "CASE WHEN {c} & 1 = 1 THEN xor(3988292384, {c} >> 1) ELSE {c} >> 1 END"
SHARDING_SQL = f"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, {_STEP.format(c="c")} FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, encode(coalesce(text, '')) AS b FROM documents),
sized AS (SELECT doc_id, key, octet_length(b)::BIGINT + 1 AS size,
                 xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(
                   regexp_extract_all(hex(b), '..'), lambda x: ('0x' || x)::BIGINT),
                   lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) AS text_crc32
          FROM d, crc),
drawn AS (SELECT doc_id, key, s, -ln((('0x' || substr(md5('s0:' || s || ':' || key), 1, 13))::BIGINT::DOUBLE + 0.5)
                                     / 4503599627370496) AS score FROM (SELECT DISTINCT doc_id, key FROM d), range(17) t(s)),
placed AS (SELECT key, arg_min(s, (score, s)) FILTER (WHERE s < 16)::INT AS shard,
                  arg_min(s, (score, s))::INT AS grown_shard FROM drawn GROUP BY key)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(key || ':' || size || ':' || text_crc32), doc_id) - 1 AS slot, grown_shard
FROM sized JOIN placed USING (key)"""


@register("op5_sharding", SHARDING_SQL)
def op5(spark, sf_dir):
    return sharding.sharded_documents(table(spark, sf_dir, "documents"))


@register("op6_topk", """
    WITH flat AS (SELECT vec_id, floor(64 * unnest(embedding)::DOUBLE)::BIGINT AS x,
                         generate_subscripts(embedding, 1) AS i FROM embeddings),
         scored AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
                    FROM flat q JOIN flat c ON q.i = c.i AND q.vec_id <> c.vec_id
                    WHERE q.vec_id % 20 = 0 GROUP BY ALL),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id
                                                 ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""")
def op6(spark, sf_dir):
    return topk_search.nearest(table(spark, sf_dir, "embeddings"))


@register("op7_quality", quality_sql.statement())
def op7(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The public byte-level BPE file; installed beside the library, on every
    machine."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op8_packing")
def op8(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op9_simhash")
def op9(spark, sf_dir):
    return simhash.simhash_documents(table(spark, sf_dir, "documents"))


@register("op10_toxicity")
def op10(spark, sf_dir):
    return toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# All pairs of distinct texts that share a shingle; components by repeated
# minima over the links
MINHASH_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) >= 2
               THEN list_sort(list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])))
               ELSE words END AS items FROM w),
class AS (SELECT items, row_number() OVER () AS c, min(doc_id) AS least FROM s WHERE len(items) > 0 GROUP BY items),
flat AS (SELECT c, len(items) AS n, unnest(items) AS item FROM class),
links AS (SELECT a.c AS u, b.c AS v FROM flat a JOIN flat b ON a.item = b.item AND a.c <> b.c
          GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(c, r) AS (SELECT c, c FROM class UNION SELECT u, r FROM reach JOIN links ON reach.c = v),
component AS (SELECT reach.c, min(class.least) AS component_id FROM reach JOIN class ON reach.r = class.c GROUP BY reach.c)
SELECT s.doc_id, coalesce(len(s.items), 0)::BIGINT AS n_shingles, coalesce(component_id, s.doc_id) AS component_id,
       s.doc_id IS NOT DISTINCT FROM coalesce(component_id, s.doc_id) AS kept
FROM s LEFT JOIN class ON s.items = class.items LEFT JOIN component ON component.c = class.c"""


@register("op11_minhash", MINHASH_SQL)
def op11(spark, sf_dir):
    return minhash.minhash_documents(table(spark, sf_dir, "documents"))


@register("op12_hard_negatives", """
    WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
               FROM embeddings
               WHERE label IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
         s AS (SELECT a.vec_id AS anchor_id, a.label AS own, c.vec_id, c.label,
                      list_dot_product(a.v, c.v)::BIGINT AS score
               FROM r a JOIN r c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
         p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
               QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
         n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
                      row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
               FROM p JOIN s USING (anchor_id)
               WHERE label <> own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""")
def op12(spark, sf_dir):
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"))


@register("op13_whitening")
def op13(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
