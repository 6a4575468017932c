"""The operators of this package on the given tables, under the names and columns their contract fixes."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerhub.llm import (
    ann, bpe, chat, decontaminate, divergence, fim, html, jaccard, langid, lm, mixing, quality, warc,
)
from ledgerhub.llm.common import WORD, read, written_once

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL twin where SQL can express it."""
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def token_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    tables = bpe.load(tokenizer)
    return bpe.round_trip(docs.select("doc_id", "text"), tables).select(
        "doc_id", "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded_text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op3_bpe")
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(
        read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


@query("op10_warc", """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html,
               CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
        FROM pages
    ), g AS (
        SELECT *, CASE WHEN payload_bytes >= 1000
                       THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS first_id
        FROM p
    )
    SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first_id <> page_id THEN first_id END AS refers_to
    FROM g
""")
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(spark, read(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op4_chat", r"""
    WITH rows_ AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
               role AS role_, text AS text_ FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
    ), escaped AS (
        SELECT *, length(regexp_replace(replace(text, '\', '\\'),
            '([<\[])(\||/?s>|/?INST\]|</?SYS>>|start_of_turn>|end_of_turn>)', '\1\\\2', 'g'))
          + length(regexp_replace(replace(role, '\', '\\'),
            '([<\[])(\||/?s>|/?INST\]|</?SYS>>|start_of_turn>|end_of_turn>)', '\1\\\2', 'g'))
          + length('<|turn|><|text|><|end|>') + 1 AS written
        FROM rows_
    ), joined AS (
        SELECT conv_id, count(*) AS n_turns, sum(written) AS formatted_chars,
               string_agg(role || chr(10) || text || chr(10), ''
                          ORDER BY turn NULLS FIRST, role_ NULLS FIRST, text_ NULLS FIRST) AS turns,
               coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role_ NULLS FIRST, text_ NULLS FIRST)
                        FILTER (WHERE role = 'assistant'), '') AS loss
        FROM escaped GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
           sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
    FROM joined
""")
def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    planted = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.lit(control).alias("prompt"), F.lit(control).alias("response")
    )
    records = chat.by_conversation(read(spark, folder, "conversations")).unionByName(
        planted, allowMissingColumns=True
    )
    back = chat.read_back(chat.formatted(chat.canonical(records)))
    line = lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))
    loss = F.array_join(F.transform(F.filter("read_turns", lambda x: x["loss"]), lambda x: x["text"]), "")
    return back.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("read_turns", line), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


QUALITY_SQL = r"""
    WITH listed AS (
        SELECT doc_id, lang, source, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
               [x FOR x IN string_split(coalesce(text, ''), chr(10))
                IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines_
        FROM documents
    ), places AS (
        SELECT doc_id, i, words[i:i + 4] AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM listed)
    ), twice AS (
        SELECT doc_id, i FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM places) WHERE n > 1
    ), covered AS (
        SELECT doc_id, CAST(sum(least(5, coalesce(nxt - i, 5))) AS BIGINT) AS n_repeat_words
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice)
        GROUP BY doc_id
    ), counted AS (
        SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
               CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
               CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
               CAST(len(lines_) - len(list_distinct(lines_)) AS BIGINT) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words,
               CAST(len(lines_) AS BIGINT) AS n_lines
        FROM listed LEFT JOIN covered USING (doc_id)
    ), based AS (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
    ), ratios AS (
        SELECT *, unnest(['symbols', 'dup_lines', 'word_length']) AS ratio,
               unnest([n_symbols, n_dup_lines, word_chars]) AS number, unnest([100, 1000, 100]) AS parts,
               unnest([n_words, n_lines, n_words]) AS size_,
               unnest([60, 98, 98]) AS percent, unnest([4, 3, 3]) AS times
        FROM based WHERE NOT base_failed
    ), binned AS (
        SELECT *, (value >> greatest(length(bin(value)) - 10, 0))
                  << greatest(length(bin(value)) - 10, 0) AS b
        FROM (SELECT *, number * parts // size_ AS value FROM ratios)
    ), ranked AS (
        SELECT 0 AS level, lang, source, ratio, percent, times, b FROM binned
        UNION ALL SELECT 1, lang, NULL, ratio, percent, times, b FROM binned
        UNION ALL SELECT 2, NULL, NULL, ratio, percent, times, b FROM binned
    ), places_ AS (
        SELECT *, n * (100 - percent) - 2 * sqrt(n * percent * (100 - percent)) AS room
        FROM (SELECT *, row_number() OVER (PARTITION BY level, lang, source, ratio ORDER BY b) AS r,
                     count(*) OVER (PARTITION BY level, lang, source, ratio) AS n FROM ranked)
    ), quantiles AS (
        SELECT level, lang, source, ratio, times,
               CASE WHEN ratio = 'word_length' THEN min(b) FILTER (WHERE r * 100 >= n * 50) ELSE 0 END AS centre,
               min(b) FILTER (WHERE n >= 50 AND room >= 0 AND r * 100 >= room) AS inner_,
               min(b) FILTER (WHERE n >= 50 AND room >= 0 AND (n - r) * 100 <= room) AS outer_
        FROM places_ GROUP BY level, lang, source, ratio, times
    ), fences AS (
        SELECT level, lang, source, ratio, centre + times * (outer_ - centre) AS high,
               CASE WHEN ratio = 'word_length' THEN centre - times * (centre - inner_) END AS low FROM quantiles
    ), limited AS (
        SELECT x.*, coalesce(a.low, b.low, c.low) AS low, coalesce(a.high, b.high, c.high) AS high
        FROM binned x
        JOIN fences a ON a.level = 0 AND a.lang IS NOT DISTINCT FROM x.lang
                     AND a.source IS NOT DISTINCT FROM x.source AND a.ratio = x.ratio
        JOIN fences b ON b.level = 1 AND b.lang IS NOT DISTINCT FROM x.lang AND b.ratio = x.ratio
        JOIN fences c ON c.level = 2 AND c.ratio = x.ratio
    ), verdicts AS (
        SELECT doc_id, bool_and(
            coalesce(value >= low OR power(CAST(number * parts - low * size_ AS DOUBLE), 2)
                                     <= 4.0 * parts * parts * CAST(number AS DOUBLE), true)
            AND coalesce(value <= high OR power(CAST(number * parts - high * size_ AS DOUBLE), 2)
                                          <= 4.0 * parts * parts * CAST(number AS DOUBLE), true)) AS kept
        FROM limited GROUP BY doc_id
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           coalesce(kept, false) AS kept
    FROM based LEFT JOIN verdicts USING (doc_id)
"""


@query("op5_quality", QUALITY_SQL)
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rules(read(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query("op6_langid")
def op6_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op9_lm")
def op9_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", lm.held_out().alias("held_out"))
    return lm.score(docs, ~F.col("held_out")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


#: The mix of the given tables: sources in four domains by number, and weights by name.
DOMAIN_SQL = """CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4') THEN 'web'
    WHEN source IN ('src5', 'src6', 'src7', 'src8', 'src9') THEN 'books'
    WHEN source IN ('src10', 'src11', 'src12', 'src13', 'src14') THEN 'news' ELSE 'forum' END"""
MIX_WEIGHTS: mixing.Weights = {
    ("web",): 3, ("books",): 4, ("news",): 2, ("forum",): 1,
    ("*", "en"): 4, ("*", "de"): 3, ("*", "fr"): 2, ("*", "es"): 2,
    ("web", "en"): 2, ("*", "*", "src0"): 2, ("*", "*", "src7"): 3,
}
MIX_SEED = 17


@query("op1_mixing", f"""
    WITH d AS (
        SELECT doc_id, lang AS lang_, source AS source_, {DOMAIN_SQL} AS domain, coalesce(lang, '') AS lang,
               coalesce(source, '') AS source,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
        FROM documents
    ), leaves AS (
        SELECT domain, lang, source, sum(n_tokens) AS have FROM d GROUP BY ALL
    ), {mixing.shares_sql(MIX_WEIGHTS, 75, 2)},
    shares AS (
        SELECT domain, lang, source, budget // have AS epochs, budget % have AS rest
        FROM b3 JOIN leaves USING (domain, lang, source) WHERE budget > 0
    ), k AS (
        SELECT *, md5('{MIX_SEED}|' || CAST(epochs AS VARCHAR) || '|'
                      || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
        FROM d JOIN shares USING (domain, lang, source)
    ), u AS (
        SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k) AS until FROM k
    )
    SELECT doc_id, domain, lang_ AS lang, source_ AS source, CAST(n_tokens AS BIGINT) AS n_tokens,
           CAST(unnest(range(0, CAST(epochs + CASE WHEN rest > 0 AND until <= rest THEN 1 ELSE 0 END AS BIGINT)))
                AS INTEGER) AS epoch
    FROM u
""")
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select(
        "doc_id", F.expr(DOMAIN_SQL).alias("domain"), "lang", "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"),
    )
    docs = written_once(docs, "mix-documents")
    return mixing.mix(docs, F.col("domain"), MIX_WEIGHTS, seed=MIX_SEED, tokens=F.col("n_tokens"))


@query("op2_jaccard")
def op2_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.classes(read(spark, folder, "documents"))


@query("op7_ann")
def op7_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(read(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op8_html")
def op8_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.with_length(html.main_text(read(spark, folder, "pages")))


#: A-Z to lower case, and nothing else.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_decontaminate", rf"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
    ), items AS (
        SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
               regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
    ), windows AS (
        SELECT DISTINCT item, least(len(words), 10) AS size, unnest(
            [array_to_string(words[i:i + least(len(words), 10) - 1], ' ')
             FOR i IN range(1, greatest(len(words) - 10, 0) + 2)]) AS win
        FROM items WHERE len(words) > 0
    ), sizes AS (SELECT DISTINCT size FROM windows), places AS (
        SELECT r, size, i, array_to_string(words[i:i + size - 1], ' ') AS win
        FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, sizes)
    ), found AS (
        SELECT r, size, i, win FROM places WHERE (size, win) IN (SELECT (size, win) FROM windows)
    ), hit AS (
        SELECT r, count(DISTINCT place) AS n_hit
        FROM (SELECT r, unnest(range(i, i + size)) AS place FROM found) GROUP BY r
    ), named AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT r, item FROM found JOIN windows USING (size, win)) GROUP BY r
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
""")
def op11_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.mark(docs, read(spark, folder, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op12_divergence", rf"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all({LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
    ), groups_ AS (SELECT DISTINCT lang, source FROM d), words AS (
        SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs
        FROM (SELECT r, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL
    ), kept AS (
        SELECT lang, term, sum(n) AS lang_n FROM words GROUP BY ALL HAVING sum(docs) >= 30
    ), langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
    cells AS (
        SELECT g.lang, g.source, k.term, k.lang_n, coalesce(w.n, 0) AS n,
               sum(coalesce(w.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
        FROM groups_ g JOIN kept k ON k.lang = g.lang
        LEFT JOIN words w ON w.lang = g.lang AND w.source = g.source AND w.term = k.term
    ), shares AS (
        SELECT c.lang, c.source, c.term, c.n,
               1 + CAST(1000000000 * (c.n + 5)::HUGEINT // (c.total + 5 * v) AS BIGINT) AS p,
               1 + CAST(1000000000 * (c.lang_n + 5)::HUGEINT // (l.total + 5 * v) AS BIGINT) AS q
        FROM cells c JOIN langs l ON l.lang = c.lang
    ), pairs AS (
        SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
        FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
        LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
        GROUP BY ALL
    ), listed AS (
        SELECT lang, source, 'pair' AS part, item, value FROM pairs
        UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER)
                  AS rank FROM listed
    )
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""")
def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read(spark, folder, "documents"))


@query("op13_fim", r"""
    WITH t AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS tokens,
               sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
    ), u AS (
        SELECT doc_id, text, tokens, len(tokens) AS n,
               CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
               CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t
    ), v AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                         OR h3 % 100 >= 50 THEN 'plain'
                    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u
    ), w AS (
        SELECT doc_id, text, n, form, array_to_string(tokens[1:a], '') AS pre,
               array_to_string(tokens[a + 1:b], '') AS mid, array_to_string(tokens[b + 1:], '') AS suf FROM v
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                  ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM w
""")
def op13_fim(spark: SparkSession, folder: str) -> DataFrame:
    made = fim.transform(read(spark, folder, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
