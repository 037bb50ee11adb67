"""Registered queries of the package: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    chat_format,
    collocations,
    decontaminate,
    jaccard_join,
    kd_shards,
    pieces,
    rule_lists,
    simhash,
    suffix_dedup,
    token_counts,
    token_pack,
    turn_repair,
    weak_quality,
)
from tickloom.session import work_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows of ten words occur in."""
    found = decontaminate.scan_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 400 bytes that stand anywhere else."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept", "carried")


def op3_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return weak_quality.classify(table(spark, sf_dir, "documents")).drop("carried")


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return kd_shards.shard_documents(table(spark, sf_dir, "documents"))


def op5_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, and of one that says the template's control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat_format.conversation_digests(chat_format.format_conversations(rows.unionByName(added)))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_bit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to the packed format and read back."""
    path = work_path(spark, "token-blocks")
    token_pack.write_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_pack.read_documents(spark, path)


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document and whether they decode to its text."""
    return pieces.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and whether the learnt rules keep it."""
    return rule_lists.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    return turn_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_wu_manber": op1_wu_manber,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_weak_labels": op3_weak_labels,
    "op4_kd_shards": op4_kd_shards,
    "op5_chosen_path_join": op5_chosen_path_join,
    "op6_chat_format": op6_chat_format,
    "op7_token_counts": op7_token_counts,
    "op8_bit_pack": op8_bit_pack,
    "op9_sentence_pieces": op9_sentence_pieces,
    "op10_decision_list": op10_decision_list,
    "op11_simhash": op11_simhash,
    "op12_turn_repair": op12_turn_repair,
    "op13_collocations": op13_collocations,
}

#: Lower-cased words of the contract, in DuckDB's dialect.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SAFE = r"replace(replace(replace({}, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>')"
_SAID = r"\### Assistant: </turn> ok"

ORACLES: dict[str, str] = {
    "op1_wu_manber": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        p AS (SELECT DISTINCT item_id, m, array_to_string(w[k:k + m - 1], ' ') AS t
            FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS k FROM (SELECT *, least(10, len(w)) AS m FROM i WHERE len(w) > 0))),
        s AS (SELECT doc_id, m, k, array_to_string(w[k:k + m - 1], ' ') AS t
            FROM (SELECT d.*, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM p))),
        h AS (SELECT doc_id, s.m, k, item_id FROM s JOIN p ON p.m = s.m AND p.t = s.t),
        a AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS place FROM h) GROUP BY 1),
        b AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY 1)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(x, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN a ON a.doc_id = d.doc_id LEFT JOIN b ON b.doc_id = d.doc_id""",
    "op6_chat_format": f"""WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '{_SAID}'), (-7, 1, 'assistant', '{_SAID}')),
        f AS (SELECT *, role = 'assistant' AS learnt,
            length('### ' || replace({_SAFE.format("role")}, ':', '\\:') || ': ' || {_SAFE.format("text")} || '</turn>' || chr(10)) AS n FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE learnt), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE learnt), '')) AS loss_sha256,
            CAST(sum(n) AS BIGINT) AS formatted_chars FROM f GROUP BY 1""",
    "op12_turn_repair": r"""WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
        given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS named FROM conversations),
        hit AS (SELECT * EXCLUDE (named), xor(list_reduce(list_prepend(4294967295, list_transform(named, lambda x: CAST(ascii(x) AS BIGINT))),
            lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM given, tab),
        damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
            unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM hit WHERE kind <> 0),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
        judged AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
            NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open_end, left(role, 1) AS initial,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
        lattice AS (SELECT *, blank OR again AS gone, open_end AND NOT blank AND NOT again AS truncated FROM judged),
        added(state, mid, c, e) AS (VALUES ('-', '-', 0, ''), ('-', 'u', 3, 'I'), ('-', 'a', 6, 'II'), ('s', 's', 0, ''), ('s', 'u', 3, 'I'), ('s', 'a', 6, 'II'),
            ('u', 'u', 0, ''), ('u', 'a', 3, 'I'), ('a', 'a', 0, ''), ('a', 'u', 3, 'I')),
        follows(mid, nx) AS (VALUES ('-', 's'), ('-', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u'), ('-', ''), ('s', ''), ('u', ''), ('a', '')),
        paths AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '-' AS state, {'c': CAST(0 AS BIGINT), 'e': ''} AS best FROM placed
            UNION ALL SELECT p.conv_id, p.i + 1, CASE WHEN nx = '' THEN f.mid ELSE nx END,
                min({'c': p.best.c + a.c + CASE WHEN nx = '' THEN 4 ELSE CASE WHEN nx = r.initial THEN 0 ELSE 3 END + CASE WHEN r.truncated THEN 3 ELSE 0 END END,
                    'e': p.best.e || a.e || CASE WHEN nx = '' THEN 'D' WHEN nx = r.initial THEN 'K' ELSE 'R' END})
            FROM paths p JOIN added a ON a.state = p.state JOIN follows f ON f.mid = a.mid
                JOIN lattice r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
            WHERE nx = '' OR (NOT r.gone AND (nx = r.initial OR nx IN ('u', 'a'))) GROUP BY 1, 2, 3),
        whole AS (SELECT conv_id, max(i) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank,
            count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM lattice GROUP BY 1),
        final AS (SELECT w.conv_id, min({'c': p.best.c + a.c, 'e': p.best.e || a.e}) AS best FROM whole w
            JOIN paths p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.i = w.n JOIN added a ON a.state = p.state AND a.mid IN ('-', 'a') GROUP BY 1),
        letters AS (SELECT conv_id, unnest(string_split(best.e, '')) AS e, unnest(range(1, length(best.e) + 1)) AS p FROM final),
        eaten AS (SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i FROM letters),
        kept AS (SELECT x.conv_id, x.e, x.p, r.role, CASE WHEN x.e = 'I' THEN '' ELSE r.text END AS text, row_number() OVER (PARTITION BY x.conv_id ORDER BY x.p) AS q,
            max(CASE WHEN x.e = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY x.conv_id) AS led
            FROM eaten x LEFT JOIN lattice r ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND r.i = x.i AND x.e <> 'I' WHERE x.e <> 'D'),
        mended AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (q - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS lines
            FROM kept GROUP BY 1)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
            coalesce(illegal, 0) AS illegal, coalesce(f.best.c, 0) AS cost, coalesce(f.best.e, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
            FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM c.conv_id
            LEFT JOIN final f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN mended m ON m.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op13_collocations": r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang,
            unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
        s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS k FROM p),
        g AS (SELECT lang, w[k:k + m - 1] AS w, count(*) AS f FROM s, (SELECT unnest(range(1, 6)) AS m) WHERE k + m - 1 <= len(w) GROUP BY 1, 2),
        t AS (SELECT lang, CAST(sum(f) AS HUGEINT) AS n FROM g WHERE len(w) = 1 GROUP BY 1),
        c AS (SELECT lang, w, f FROM g WHERE len(w) > 1 AND f >= 100),
        b AS (SELECT DISTINCT lang, unnest([w[:len(w) - 1], w[2:]]) AS w, f FROM c WHERE len(w) > 2),
        o AS (SELECT c.* FROM c ANTI JOIN b ON c.lang = b.lang AND c.w = b.w AND c.f = b.f),
        u AS (SELECT lang, w, f, unnest(range(1, len(w))) AS k FROM o),
        x AS (SELECT u.lang, u.w, u.f AS a, u.k, h.f AS l, r.f AS r, t.n, CAST(1000 AS HUGEINT) * u.f * t.n // (CAST(h.f AS HUGEINT) * r.f) AS score
            FROM u JOIN t ON t.lang = u.lang JOIN g h ON h.lang = u.lang AND h.w = u.w[:u.k] JOIN g r ON r.lang = u.lang AND r.w = u.w[u.k + 1:]),
        y AS (SELECT *, array_to_string(w, ' ') AS phrase FROM x QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
            FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM y) WHERE rank <= 2000""",
}
