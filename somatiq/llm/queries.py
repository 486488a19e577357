"""The queries of this subpackage, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, divergence, embeddings, fingerprints, jaccard, mixing, packing, quality, spelling, suffixtree, tokenfiles, toxicity, urlfilter
from .common import crc32_mod, read, shared_folder

#: The filter list of the query (host, path, action).
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
#: From this score on a document counts as toxic, or as good.
CUT = 0.3
QUALITY_FOLDS, QUALITY_HELD = 5, 0
TOXIC_FOLDS, TOXIC_HELD = 4, 2
LM_FOLDS, LM_HELD = 10, 0


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path(), window=2048)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0).select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(extra)))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(read(spark, sf_dir, "pages"), URL_RULES)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train_quality(docs, read(spark, sf_dir, "labels"), crc32_mod(F.col("label_id"), QUALITY_FOLDS) != QUALITY_HELD)
    return _judged(quality.score_quality(docs, model), QUALITY_FOLDS, QUALITY_HELD)


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = suffixtree.score_texts(read(spark, sf_dir, "documents"), crc32_mod(F.col("doc_id"), LM_FOLDS) != LM_HELD)
    return scored.select("doc_id", (crc32_mod(F.col("doc_id"), LM_FOLDS) == LM_HELD).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_toxicity(docs, read(spark, sf_dir, "labels"), crc32_mod(F.col("label_id"), TOXIC_FOLDS) != TOXIC_HELD)
    return _judged(toxicity.score_toxicity(docs, model), TOXIC_FOLDS, TOXIC_HELD)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"), percent=85, k=4)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"), every=97, shortest=5, least=3, ratio=2)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read(spark, sf_dir, "documents"), least_docs=30, top=50)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = tokenfiles.stored_tokens(read(spark, sf_dir, "documents"), tokenizer_path(), end=2, path=shared_folder(spark, "token-files"))
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def _judged(scored: DataFrame, folds: int, held: int) -> DataFrame:
    return scored.select("doc_id", (crc32_mod(F.col("doc_id"), folds) == held).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_embedding_duplicates, op2_packing, op3_mixing, op4_chat, op5_url_filter, op6_quality, op7_suffix_tree, op8_fingerprints, op9_toxicity, op10_jaccard_join, op11_spelling_variants, op12_source_divergence, op13_token_files)}


def _sql_escape(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


def _crc_table() -> list[int]:
    """The table of the usual reflected 32-bit checksum, by its rule."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
_EDGE = len(chat.OPEN) + 1 + len(chat.CLOSE)

ORACLES: dict[str, str] = {
    "op1_embedding_duplicates": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9),
        reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links,
               least(vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = v.vec_id), vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = v.vec_id), vec_id)) AS kept
        FROM v""",
    "op4_chat": f"""
        WITH t AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length({_sql_escape("role")}) + length({_sql_escape("text")}) + {_EDGE})::BIGINT AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op5_url_filter": f"""
        WITH p AS (
            SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM pages),
        rules(rule_host, rule_path, action) AS (VALUES {_RULES_SQL}),
        hits AS (
            SELECT p.n, rule_host || rule_path AS rule, action, row_number() OVER (PARTITION BY p.n ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path DESC) AS k
            FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
        SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN hits ON p.n = hits.n AND k = 1""",
    "op10_jaccard_join": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
        u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM u x JOIN u y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
        reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = s.doc_id), doc_id)) AS component_id FROM s""",
    "op11_spelling_variants": f"""
        WITH RECURSIVE d AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
        r AS (SELECT id, run, count(*) AS times FROM d GROUP BY id, run),
        b AS (SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END))),
            lambda h, x: xor(h >> 8, ({_crc_table()}::BIGINT[])[xor(h & 255, x) + 1])), 4294967295::BIGINT) AS h FROM r),
        o AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM b),
        w AS (SELECT word, sum(times)::BIGINT AS n FROM o WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
        k AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM w)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS m FROM k a JOIN k b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT k.word, w.word, w.n FROM k JOIN w ON k.rest = w.word
            UNION SELECT w.word, k.word, k.n FROM k JOIN w ON k.rest = w.word),
        best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word),
        f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, (SELECT min(other) FROM near x WHERE x.word = w.word AND x.m = best.m AND best.m >= 2 * w.n) AS form, CASE WHEN best.m >= 2 * w.n THEN best.m END AS form_n FROM w LEFT JOIN best ON w.word = best.word),
        chain AS (SELECT word, word AS root FROM f UNION ALL SELECT c.word, f.form FROM chain c JOIN f ON c.root = f.word WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM f JOIN chain c ON f.word = c.word JOIN f g ON g.word = c.root AND g.form IS NULL""",
    "op12_source_divergence": r"""
        WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        u AS (SELECT lang, source, doc, unnest(t) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS n FROM u GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
        c AS (SELECT u.lang, u.source, u.term, count(*) AS n FROM u JOIN kept USING (lang, term) GROUP BY u.lang, u.source, u.term),
        g AS (SELECT DISTINCT lang, source FROM d),
        v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
        s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
        p AS (
            SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.n, 0) + 5 * v.v) AS p,
                   1 + (1000000000::HUGEINT * (kept.n + 5)) // (v.n + 5 * v.v) AS q
            FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c USING (lang, source, term)),
        pairs AS (
            SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce((SELECT sum(abs(a.p - b.p)) FROM p a JOIN p b USING (lang, term) WHERE a.lang = x.lang AND a.source = x.source AND b.source = y.source), 0)::BIGINT AS value
            FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM (FROM pairs UNION ALL FROM terms))
        WHERE part = 'pair' OR rank <= 50""",
}
