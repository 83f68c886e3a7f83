"""Registered queries of this subpackage: thin callers of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lens.llm import bpe_automaton, chat_format, collocations, conversation_repair, embedding_dedup, hilbert_ann, licences, minimax_shards, mixing, ngram_join, token_counts, toxicity, warc
from retail_lens.llm.common import importable, staging


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file is; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return importable(spark).read.parquet(f"{folder}/{table}.parquet")


def op1_hilbert_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert_ann.nearest(_read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_minimax_shards(spark: SparkSession, folder: str) -> DataFrame:
    return minimax_shards.shard(_read(spark, folder, "documents"), shards=40, overhead=16)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_read(spark, folder, "embeddings"), least=0.95)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    model = toxicity.fit(docs, _read(spark, folder, "labels"))
    return toxicity.grade(docs, model).select("doc_id", "toxicity.*")


def op6_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_join(_read(spark, folder, "documents"), width=3, percent=90)


def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, folder, "documents"), weights=(5, 2, 1), limit=3)
    # The pieces say where each word goes: shard and place come from the splitting tree and the permuted blocks.
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "pieces")


def op8_licences(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    return licences.scan(docs, licences.fit(docs))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = f"{staging(spark).root}/archives"
    warc.write(_read(spark, folder, "pages"), archives, least_bytes=0)
    return warc.capture_report(warc.assemble(warc.read(spark, archives)))


def op10_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_automaton.round_trip(_read(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(_read(spark, folder, "conversations")))[1]


def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.format_and_digest(rows.unionByName(planted), tokenizer("byte_bpe_50k.json"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_read(spark, folder, "documents"), least=10, covered=50, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_hilbert_neighbours, op2_minimax_shards, op3_token_counts, op4_embedding_dedup, op5_toxicity, op6_ngram_join, op7_source_mixing, op8_licences, op9_warc, op10_bpe_round_trip, op11_conversation_repair, op12_chat_format, op13_collocations)
}

#: DuckDB SQL where it can give the same rows.
ORACLE: dict[str, str] = {
    "op4_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), l AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
            ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
        ), reach(a, b) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a
        ), c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
        ), n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM c LEFT JOIN n USING (vec_id)""",
    "op6_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY ALL
        ), l AS (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
        ), reach(a, b) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a
        )
        SELECT a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id
        FROM reach LEFT JOIN n ON doc_id = a GROUP BY a""",
    "op9_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS body, sha1(encode(coalesce(html, ''))) AS hex FROM pages
        ), r AS (
            SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM p
        )
        SELECT page_id, octet_length(body)::BIGINT AS payload_bytes,
            list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)),
                'string_agg', '') AS payload_digest,
            CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id < top THEN top END AS refers_to
        FROM r""",
    "op12_chat_format": r"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), e AS (
            SELECT *, regexp_replace(role, p, '\1\\\2\3', 'g') AS role_out, regexp_replace(text, p, '\1\\\2\3', 'g') AS text_out
            FROM r, (SELECT '([<\[])(\\*)(\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|unk>|pad>|INST\]|/INST\]|\|endoftext\|>|\|startoftext\|>|\|system\|>|\|user\|>|\|assistant\|>)' AS p)
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(length(role_out) + length(text_out) + length('<|im_start|><|im_sep|><|im_end|>'))::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op13_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
        ), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
        ), g AS (
            SELECT lang, unnest(list_transform(range(1, len(ws) + 1), lambda i: {'k': 1, 'p': ws[i], 'h': '', 't': '', 'x': '', 'y': ''})
                || list_transform(range(1, len(ws)), lambda i: {'k': 2, 'p': ws[i] || ' ' || ws[i + 1], 'h': ws[i], 't': ws[i + 1], 'x': '', 'y': ''})
                || list_transform(range(1, len(ws) - 1), lambda i: {'k': 3, 'p': ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2],
                    'h': ws[i], 't': ws[i + 1] || ' ' || ws[i + 2], 'x': ws[i] || ' ' || ws[i + 1], 'y': ws[i + 2]})) AS e FROM w
        ), f AS (
            SELECT lang, e.k AS k, e.p AS phrase, any_value(e.h) AS h, any_value(e.t) AS t, any_value(e.x) AS x, any_value(e.y) AS y, count(*) AS a
            FROM g GROUP BY ALL
        ), n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
        ), c AS (SELECT * FROM f WHERE k > 1 AND a >= 10
        ), parts AS (
            SELECT lang, k, phrase, a, 1 AS j, h AS head, t AS tail FROM c UNION ALL SELECT lang, k, phrase, a, 2, x, y FROM c WHERE k = 3
        ), cut AS (
            SELECT q.*, u.a AS l, v.a AS r, (1000000::HUGEINT * q.a * q.a // (u.a::HUGEINT * v.a))::BIGINT AS score
            FROM parts q JOIN f u ON u.lang || chr(10) || u.phrase = q.lang || chr(10) || q.head
                JOIN f v ON v.lang || chr(10) || v.phrase = q.lang || chr(10) || q.tail
        ), best AS (
            SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
        ), longer AS (
            SELECT lang, phrase, max(a) AS most FROM (SELECT lang, x AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, t, a FROM c WHERE k = 3) GROUP BY ALL
        ), kept AS (
            SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE k = 3 OR most IS NULL OR 100 * most < 50 * a
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
}
