"""The registered queries of the training-data operators, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchwork.llm.common import LOWER, UPPER, load
from batchwork.session import ensure_checkpoint_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@register("op7_exact_dedup", r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
    g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm.exact_dedup import exact_dedup
    out = exact_dedup(load(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


# SHA-1 in SQL is spelt in hex; base32 of its 160 bits: 32 groups of 5 bits
BASE32_SQL = """array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST(
      (('0x' || rpad(substr(h, 1 + (i * 5) // 4, 2), 2, '0'))::INTEGER >> (3 - (i * 5) % 4)) & 31 AS INTEGER)]), '')"""


@register("op3_warc", f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages),
    d AS (SELECT page_id, x, strlen(x) AS payload_bytes, sha1(x) AS h, min(page_id) OVER (PARTITION BY x) AS first_id FROM p)
    SELECT page_id, payload_bytes, {BASE32_SQL} AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM d""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm import warc
    from batchwork.session import scratch_path
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.plan_records(load(spark, sf_dir, "pages")), path)
    return warc.page_records(spark, path)


@register("op8_url_filter")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm.url_filter import url_filter
    out = url_filter(load(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", "host", "path", "rule", "verdict", "score")


_CONTROL = r"""([<])(\\*)(s>|/s>|<SYS>>|</SYS>>)"""
_CONTROL_B = r"""(\[)(\\*)(INST\]|/INST\]|ROLE\]|/ROLE\])"""


def _escaped(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '{_CONTROL}', '\1\2\\\3', 'g'), '{_CONTROL_B}', '\1\2\\\3', 'g')"


@register("op10_chat", f"""
    WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
    e AS (SELECT *, length({_escaped('text')}) AS n_text, length({_escaped('role')}) AS n_role FROM r)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           (3 + sum(n_text + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 WHEN 'assistant' THEN 5
                             ELSE 17 + n_role END))::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm import chat
    from batchwork.llm.common import write_scratch
    extra = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id long, turn long, role string, text string")
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(write_scratch(chat.format_chat(rows), "chat"))


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm import toxicity
    from batchwork.llm.common import held_out
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    # documents have no address: the source stands for the host, the language for the path
    from batchwork.llm.common import held_out
    from batchwork.llm.quality import quality
    out = quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "evidence", "host_posterior", "path_posterior",
                      "score", F.col("keep").cast("int").alias("predicted"), "keep")


WORDS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DECONTAMINATION_SQL = f"""
    b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
    win AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS x
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT len(x) AS n FROM win),
    pos AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
    occ AS (SELECT doc_id, i, n, item_id FROM (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS x FROM pos) JOIN win USING (x)),
    hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) FROM occ) GROUP BY doc_id),
    its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)"""


@register("op2_decontamination", f"""
    WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents), {DECONTAMINATION_SQL}
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm.decontamination import decontaminate
    out = decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


@register("op5_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm.jaccard_join import jaccard_components
    out = jaccard_components(load(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@register("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm import sentencepiece
    docs = load(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = sentencepiece.encode(docs, decoded_col="decoded")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                       F.length("decoded").cast("long").alias("decoded_chars"), (F.col("decoded") == F.col("text")).alias("round_trip"))


@register("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm.suffix_dedup import repeated_passages
    out = repeated_passages(load(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "start_word", "n_words", "n_repeated")


@register("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm.whitening import whiten
    return whiten(load(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@register("op11_language_id")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm import language_id
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language_id.fit(docs, known=~held)
    return language_id.identify(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@register("op12_ranked_search", f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
    g AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
    q AS (SELECT DISTINCT item_id, unnest(w) AS term FROM (SELECT item_id, {WORDS_SQL} AS w FROM benchmark)),
    t AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
          WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    f AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM t, g GROUP BY term),
    s AS (SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
          FROM q JOIN t USING (term) JOIN f USING (term), g GROUP BY item_id, r, doc_id),
    k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from batchwork.llm import ranked_search
    index = ranked_search.build_index(load(spark, sf_dir, "documents"))
    found = ranked_search.search(index, load(spark, sf_dir, "benchmark"), k=10)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
