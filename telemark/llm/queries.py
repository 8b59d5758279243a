"""One query per operator, with production parameters, over whole tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telemark.llm.tables import ship

_BUILD: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        _BUILD[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_BUILD)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query("op7_decontamination")
def op7(spark, sf_dir):
    from telemark.llm import decontaminate as D
    found = D.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return D.digest(found)


@query("op8_token_counts")
def op8(spark, sf_dir):
    import public_tokenizers
    from telemark.llm.token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op10_ngram_jaccard_join")
def op10(spark, sf_dir):
    from telemark.llm.ngram_join import link
    return link(table(spark, sf_dir, "documents"))


@query("op1_best_fit_packing")
def op1(spark, sf_dir):
    from telemark.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def op3(spark, sf_dir):
    from telemark.llm import toxicity as X
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = X.score(docs, X.corpus_chain(docs, labels), X.CHAIN, ["doc_id"])
    return scored.withColumn("rejected", scored.p_toxic >= X.THRESHOLD)


SHARD_LIMIT = 1 << 20  # bytes; small enough that the given tables need many shards


@query("op4_sharding", f"""
    WITH d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
                      ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM documents),
         l AS (SELECT depth, h >> (32 - depth) AS p, sum(n_bytes)::BIGINT AS b, count(*) AS n
               FROM d, (SELECT unnest(range(0, 33))::INTEGER AS depth) GROUP BY ALL),
         f AS (SELECT doc_id, n_bytes, h, l.depth, l.p, l.b,
                      row_number() OVER (PARTITION BY doc_id, n_bytes ORDER BY l.depth) AS r
               FROM d JOIN l ON l.p = h >> (32 - l.depth) WHERE l.b <= {SHARD_LIMIT} OR l.n = 1)
    SELECT doc_id, n_bytes, 'b' || CASE WHEN depth = 0 THEN '' ELSE lpad(bin(p), depth, '0') END AS shard,
           depth, b AS shard_bytes, b > {SHARD_LIMIT} AS oversize FROM f WHERE r = 1""")
def op4(spark, sf_dir):
    from telemark.llm.sharding import assign
    return assign(table(spark, sf_dir, "documents"), SHARD_LIMIT)


# Fixed rules of the contract, then the pattern rules that judge what these leave open.
HOST_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
              ("net/es/", "block"), ("net/fr/", "block")]
PATTERN_RULES = [("*/casino/", "block"), ("*/adult/", "block"), ("*/login/", "block"), ("*/ads/", "block"),
                 ("blog.*/print/", "block"), ("*/tracking/*.gif", "block"), ("m.*/amp/", "block"),
                 ("*/en/*.html", "allow"), ("org/es/*.html", "block")]


def _regex(rule: str) -> str:
    body = "".join(".*" if c == "*" else "\\" + c if c in ".+?()[]{}^$|\\" else c for c in rule)
    return ("(?s)^" if rule.startswith("*") else "(?s)^(?:[^/]*\\.)?") + body + ".*"


def _tier(rules) -> str:
    return "VALUES " + ", ".join(f"('{r}', '{a}', '{_regex(r)}')" for r, a in rules)


@query("op2_url_filter", f"""
    WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
         p AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
         one(rule, action, pattern) AS ({_tier(HOST_RULES)}),
         two(rule, action, pattern) AS ({_tier(PATTERN_RULES)}),
         a AS (SELECT DISTINCT ON (host, path) host, path, rule, action FROM (SELECT DISTINCT host, path FROM p), one
               WHERE regexp_full_match(host || path, pattern) ORDER BY host, path, length(rule) DESC, rule),
         b AS (SELECT DISTINCT ON (host, path) host, path, rule, action FROM (SELECT DISTINCT host, path FROM p), two
               WHERE regexp_full_match(host || path, pattern) ORDER BY host, path, length(rule) DESC, rule)
    SELECT page_id, host, path, a.rule AS rule, b.rule AS pattern_rule, coalesce(a.action, b.action, 'allow') AS verdict
    FROM p LEFT JOIN a USING (host, path) LEFT JOIN b USING (host, path)""")
def op2(spark, sf_dir):
    from telemark.llm.url_filter import judge, rule_table
    rules = rule_table(spark, [(r, a, 1) for r, a in HOST_RULES] + [(r, a, 2) for r, a in PATTERN_RULES])
    return judge(table(spark, sf_dir, "pages"), rules)


@query("op6_nearest_neighbours")
def op6(spark, sf_dir):
    from telemark.llm.neighbours import search
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter("vec_id % 20 = 0"))


def _license_sql() -> str:
    from telemark.llm.licenses import CUE, MIN_COSINE, TEMPLATES
    words = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+(?:\.[\p{{L}}\p{{N}}]+)*')"
    notices = ", ".join(f"('{a}', '{b}')" for a, b in TEMPLATES)
    return rf"""
    WITH files AS (SELECT doc_id, text, concat_ws('/', source, lang, (doc_id // 100)::VARCHAR,
                          CASE WHEN doc_id % 50 = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END) AS path FROM documents),
         found AS (SELECT doc_id, path, trim(unnest(string_split_regex(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), '\n+')), ' ') AS unit
                   FROM files WHERE regexp_matches(text, '{CUE}')),
         units AS (SELECT DISTINCT unit FROM found WHERE regexp_matches(unit, '{CUE}')),
         tf AS (SELECT unit, term, count(*) AS tf FROM (SELECT unit, unnest({words.format('unit')}) AS term FROM units) GROUP BY ALL),
         n AS (SELECT count(*)::DOUBLE AS n FROM units),
         idf AS (SELECT term, ln((1 + max(n)) / (count(*) + 1.0)) + 1 AS idf FROM tf, n GROUP BY term),
         tpl(license, text) AS (VALUES {notices}),
         tw AS (SELECT license, text, k.term, k.tf * coalesce(idf, ln(1 + n) + 1) AS w
                FROM (SELECT license, text, term, count(*) AS tf FROM (SELECT license, text, unnest({words.format('text')}) AS term FROM tpl) GROUP BY ALL) k
                LEFT JOIN idf USING (term), n),
         tv AS (SELECT license, text, term, w / sqrt(sum(w * w) OVER (PARTITION BY license, text)) AS v FROM tw),
         uw AS (SELECT unit, term, tf * idf AS u FROM tf JOIN idf USING (term)),
         un AS (SELECT unit, sqrt(sum(u * u)) AS norm FROM uw GROUP BY unit),
         cs AS (SELECT unit, license, round(sum(u * v) / any_value(norm) + 1e-12, 6) AS cosine
                FROM uw JOIN tv USING (term) JOIN un USING (unit) GROUP BY unit, license, text),
         ub AS (SELECT DISTINCT ON (unit) unit, license, cosine FROM cs WHERE cosine >= {MIN_COSINE} ORDER BY unit, cosine DESC, license),
         own AS (SELECT DISTINCT ON (doc_id) doc_id, path, license, cosine FROM found JOIN ub USING (unit) ORDER BY doc_id, cosine DESC, license),
         dirs AS (SELECT DISTINCT regexp_extract(path, '^(.*/)', 1) AS dir FROM files),
         givers AS (SELECT regexp_extract(path, '^(.*/)', 1) AS up, arg_min(license, doc_id) AS given
                    FROM own WHERE path LIKE '%/LICENSE' GROUP BY 1),
         near AS (SELECT DISTINCT ON (dir) dir, up, given FROM dirs JOIN givers ON starts_with(dir, up) ORDER BY dir, length(up) DESC)
    SELECT f.doc_id, f.path, own.license AS own_license, own.cosine AS own_cosine, coalesce(own.license, near.given) AS license,
           CASE WHEN own.license IS NULL THEN near.up END AS license_dir
    FROM files f LEFT JOIN own USING (doc_id) LEFT JOIN near ON near.dir = regexp_extract(f.path, '^(.*/)', 1)"""


@query("op9_license_scan", _license_sql())
def op9(spark, sf_dir):
    from telemark.llm import licenses as L
    return L.scan(L.with_paths(table(spark, sf_dir, "documents")), L.template_table(spark))


@query("op5_chat_formatting")
def op5(spark, sf_dir):
    from telemark.llm import transcripts as R
    raw = R.raw_transcripts(table(spark, sf_dir, "conversations"))
    model = R.train(R.lines(raw, keep=("role",)))
    return R.turns(R.recover(raw, model))


@query("op13_token_alignment")
def op13(spark, sf_dir):
    import public_tokenizers
    from telemark.llm.alignment import align_documents
    paths = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align_documents(table(spark, sf_dir, "documents"), *paths, hashed=True)


@query("op12_conversation_repair")
def op12(spark, sf_dir):
    from telemark.llm import conversations as C
    said = table(spark, sf_dir, "conversations")
    return C.report(said, C.damage(said))


@query("op11_minhash_dedup")
def op11(spark, sf_dir):
    from telemark.llm.minhash_join import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)
