"""The registered queries of the operators: (spark, sf_dir) -> DataFrame over
the whole tables, with the digest columns that their contracts name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import fit, held_out, predict
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, fit(docs.where(~held_out())))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens, over_limit
    return over_limit(count_tokens(table(spark, sf_dir, "documents"), model_path()))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, held_out, score
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import plan, taken_words
    return taken_words(*plan(table(spark, sf_dir, "documents")))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import similar_components
    return similar_components(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import digests, scan
    return digests(scan(table(spark, sf_dir, "documents")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import copies
    return copies(table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", F.sha2("text", 256).alias("text_sha256"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepiece_codec import digests, encode
    return digests(encode(table(spark, sf_dir, "documents"), model_path(), decoded=True))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk_search import integer_vectors, top_k
    rows = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.where("vec_id % 50 = 0"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations, ranked
    return ranked(collocations(table(spark, sf_dir, "documents")))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .byte_bpe import digests
    return digests(table(spark, sf_dir, "documents"), model_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversation_trie import prefix_trie
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_token_counts, op3_toxicity, op4_mix, op5_jaccard_join, op6_secret_scan, op7_substring_dedup, op8_exact_dedup, op9_sentencepiece,
                                  op10_topk_search, op11_collocations, op12_byte_bpe, op13_conversation_trie)}

ORACLE_SQL: dict[str, str] = {
    "op5_jaccard_join": """
        WITH RECURSIVE
        t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM t),
        s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) || ':' || least(len(w), 5) AS h FROM p),
        z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT x.a, x.b FROM x JOIN z za ON za.doc_id = x.a JOIN z zb ON zb.doc_id = x.b
              WHERE 100 * c >= 80 * (za.n + zb.n - c)),
        e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        r AS (SELECT doc_id AS node, doc_id AS root FROM documents
              UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b)
        SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, m.root AS component_id
        FROM documents d LEFT JOIN z USING (doc_id)
        JOIN (SELECT node, min(root) AS root FROM r GROUP BY node) m ON m.node = d.doc_id""",
    "op7_substring_dedup": """
        WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
             p AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS pos FROM t),
             x AS (SELECT p.doc_id, pos, md5(array_to_string(w[pos:pos + 49], ' ')) AS h FROM p JOIN t USING (doc_id)),
             f AS (SELECT doc_id, pos FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS low FROM x) WHERE low < doc_id),
             i AS (SELECT t.doc_id, unnest(range(1, len(w) + 1)) AS i FROM t),
             d AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS i FROM f),
             k AS (SELECT i.doc_id, list(i.i ORDER BY i.i) AS ks FROM i ANTI JOIN d USING (doc_id, i) GROUP BY i.doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(len(ks), 0))::BIGINT AS n_removed,
               sha256(array_to_string(list_transform(coalesce(ks, []), lambda j: w[j]), ' ')) AS kept_sha256
        FROM t LEFT JOIN k USING (doc_id)""",
    "op8_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
             g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256
        FROM t JOIN g USING (text)""",
    "op10_topk_search": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
                   FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_collocations": """
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
             w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
             i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
             z AS (SELECT lang, k, w[i:i + k - 1] AS g FROM i, (VALUES (1), (2), (3)) AS v(k) WHERE i + k - 1 <= len(w)),
             f AS (SELECT lang, k, g, count(*) AS a FROM z GROUP BY ALL),
             n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
             c AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
             s AS (SELECT lang, g[1:2] AS g, a FROM c WHERE k = 3 UNION ALL SELECT lang, g[2:3], a FROM c WHERE k = 3),
             m AS (SELECT lang, g, max(a) AS most FROM s GROUP BY ALL),
             x AS (SELECT c.lang, c.g, c.k, c.a, l.k AS cut, l.a AS l, r.a AS r,
                          (1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a))::BIGINT AS score
                   FROM c JOIN f l ON l.lang = c.lang AND l.k < c.k AND l.g = c.g[1:l.k]
                   JOIN f r ON r.lang = c.lang AND r.k = c.k - l.k AND r.g = c.g[l.k + 1:c.k]),
             y AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS pick FROM x),
             k AS (SELECT y.* FROM y LEFT JOIN m USING (lang, g) WHERE pick = 1 AND (most IS NULL OR k = 3 OR 100 * most < 50 * y.a)),
             o AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM k),
             q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
        SELECT lang, rank, phrase, a, l, r, n, score FROM q JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_conversation_trie": """
        WITH r AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
             l AS (SELECT c, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS s FROM r GROUP BY c),
             h AS (SELECT c, s, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(c::VARCHAR, ''),
                                        lambda x: [ascii(x)::BIGINT + 1, 0, 0, 0, 0, 0, 0, 0, 0])),
                                    lambda a, x: CASE WHEN x > 0 THEN xor(a, x - 1)
                                                      ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END) END)) % 4 AS h FROM l),
             b AS (SELECT h.c, list_concat(coalesce(o.s[1:h.h], []), h.s[h.h + 1:]) AS s FROM h LEFT JOIN l o ON o.c = h.c - h.c % 20),
             p AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM b),
             v AS (SELECT s[1:d] AS g, d, min(c) AS conv_id, count(*) AS n, list(c ORDER BY c) FILTER (WHERE len(s) = d) AS ends FROM p GROUP BY 1, 2),
             w AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(g[d].t, '[^\\x20\\x09-\\x0D]+')) END AS w, g[1:d - 1] AS up FROM v),
             k AS (SELECT up AS g, count(*) AS n_children FROM w WHERE d > 0 GROUP BY up),
             x AS (SELECT w.*, coalesce(n_children, 0) AS n_children FROM w LEFT JOIN k USING (g)),
             a AS (SELECT x.*, unnest(range(0, d + 1)) AS j FROM x),
             t AS (SELECT g[1:j] AS g, sum((n - 1) * w)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM a GROUP BY 1)
        SELECT x.conv_id, x.d AS depth, u.conv_id AS parent_conv_id, x.n AS n_convs, x.n_children, t.n_leaves, t.saved_tokens,
               sha256(coalesce(array_to_string(x.ends, ','), '')) AS ends_sha256
        FROM x JOIN t USING (g) LEFT JOIN w u ON x.d > 0 AND u.d = x.d - 1 AND u.g = x.up""",
}
