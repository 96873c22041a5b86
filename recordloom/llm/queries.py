"""One query per operator, over the whole of its table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .fingerprints import as_string, likeness, with_fingerprint
from .lexical_search import build_index, search
from .main_text import with_main_text
from .mixing import WORD, mix_sources
from .near_dedup import near_duplicates
from .packing import pack_documents
from .quality_rules import judge_quality
from .sharding import shard_rows
from .substring_dedup import remove_repeats
from .toxicity import fit_toxicity, score_toxicity
from .url_templates import Rule, judge_urls
from .vector_codes import codebooks_digest, fit_and_encode, with_label_error
from .warc import read_warc, write_warc
from .work import work_folder, work_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

URL_RULES = [Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]

# Words that label an url as bad where no rule does.
URL_BAD_WORDS = ["adult", "ads", "casino", "pills", "porn", "spam", "viagra", "xxx"]

# The tree that the documents are mixed by: a domain holds sources, each in several languages.
DOMAINS = {"books": ["src10", "src11", "src12", "src13", "src14"], "forum": ["src18", "src19"], "reference": ["src15", "src16", "src17"]}
DOMAIN_WEIGHTS = {"web": 45, "books": 25, "reference": 20, "forum": 10}
LANGUAGE_WEIGHTS = {"en": 55, "de": 15, "es": 15, "fr": 15}
MIX_SEED = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts are one apart at most."""
    placed = shard_rows(_documents(spark, sf_dir), 24)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without repeated passages of 40 words or more, and what was cut where."""
    cut = remove_repeats(_documents(spark, sf_dir), unit="passage", min_words=40)
    return cut.select("doc_id", "text", "removed", (F.size("removed") > 0).alias("changed"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in windows of 2048 ids."""
    pieces = pack_documents(_documents(spark, sf_dir), TOKENIZER, window=2048)
    return pieces.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, and whether it is toxic."""
    docs = _documents(spark, sf_dir)
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", "severity", "grade", "toxic_probability", "toxic", (~F.col("toxic")).alias("kept"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back."""
    archives = write_warc(_table(spark, sf_dir, "pages"), work_folder(spark), least_revisit_bytes=0)
    number = lambda c: F.nullif(F.regexp_extract(c, "^urn:page:(-?[0-9]*)$", 1), F.lit("")).cast("long")
    return read_warc(archives).select(
        number("record_id").alias("page_id"),
        F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        "payload_digest", "record_type", number("refers_to").alias("refers_to"), "status")


def _next_in_order(docs: DataFrame) -> DataFrame:
    """For each document, by id and text hash, that with the next smaller id; after the last the first.

    A sorted table of ids alone is stored with its positions, so that neighbours are found
    within each part of the sort; parts are tied to the next by one row each.
    """
    keys = docs.select("doc_id", "hash", F.length("text").alias("n_chars")).distinct()
    ordered = keys.orderBy(F.desc_nulls_last("doc_id"), F.desc("hash")).withColumn("at", F.monotonically_increasing_id())
    stored = work_table(ordered).withColumn("part", F.shiftright("at", 33))
    own = F.struct("doc_id", "hash")
    firsts = stored.groupBy("part").agg(F.min_by(own, "at").alias("first"))
    over_parts = Window.orderBy("part")  # a row for each part of the sort
    after = firsts.select("part", F.coalesce(
        F.lead("first").over(over_parts),
        F.first("first").over(over_parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = stored.withColumn("next", F.lead(own).over(Window.partitionBy("part").orderBy("at")))
    found = inside.join(after, "part").withColumn("next", F.coalesce("next", "after"))
    return found.select("doc_id", "hash", "n_chars", F.col("next.doc_id").alias("next_id"), F.col("next.hash").alias("next_hash"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are.

    Rows equal in id and text are one document in the order, and each gets its result. A text is
    like an equal one, even if it is too short to have a hash.
    """
    docs = _documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    order = work_table(_next_in_order(docs))
    same = lambda a, b, c, d: F.col(a).eqNullSafe(F.col(b)) & (F.col(c) == F.col(d))
    wanted = order.select(F.col("doc_id").alias("for_id"), F.col("hash").alias("for_hash"), (F.floor(F.col("n_chars") / 3)).cast("int").alias("take"),
                          "next_id", "next_hash")
    # Own fingerprints are made before texts move. Both joins below take the same exchange of texts.
    marked = with_fingerprint(docs, "print", F.col("text"))
    # Only as much of a text as the document before it needs moves to that document, with the text's fingerprint.
    heads = marked.join(wanted, same("doc_id", "next_id", "hash", "next_hash")).select(
        "for_id", "for_hash", "next_hash", F.expr("substring(text, 1, take)").alias("head"), "take", F.col("print").alias("next_print"))
    heads = heads.groupBy("for_id", "for_hash").agg(*(F.any_value(c).alias(c) for c in ("next_hash", "head", "take", "next_print")))
    both = marked.join(heads, same("doc_id", "for_id", "hash", "for_hash")).withColumn(
        "edited", F.concat(F.expr("substring(text, 1, length(text) - take)"), "head"))
    compared = with_fingerprint(both, "edited_print", F.col("edited"))
    alike = lambda equal, other: F.when(equal, 1.0).otherwise(likeness(F.col("print"), F.col(other)))
    return compared.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("print")).alias("fingerprint"), as_string(F.col("edited_print")).alias("edited_fingerprint"),
        alike(F.col("text") == F.col("edited"), "edited_print").alias("near_edited"),
        alike(F.col("hash") == F.col("next_hash"), "next_print").alias("near_next"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document: shingles of two words, similarity 0.8."""
    return near_duplicates(_documents(spark, sf_dir), width=2, percent=80)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url; rules and, where none fits, words of the url label what the templates are judged by."""
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES, bad_words=URL_BAD_WORDS)


def mix_documents(docs: DataFrame, budget_share: float, max_epochs: int) -> DataFrame:
    """``docs`` mixed by the tree above, with the epoch."""
    domain = F.lit("web")
    for name, sources in DOMAINS.items():
        domain = F.when(F.col("source").isin(sources), name).otherwise(domain)

    def listed(level: str, weights: dict[str, int]):
        case = F.lit(1)
        for name, weight in weights.items():
            case = F.when(F.col(level) == name, weight).otherwise(case)
        return case

    return mix_sources(
        docs, {"domain": domain, "language": F.col("lang"), "origin": F.col("source")},
        {"domain": listed("domain", DOMAIN_WEIGHTS), "language": listed("language", LANGUAGE_WEIGHTS), "origin": F.lit(1)},
        budget_share, max_epochs, MIX_SEED)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of nine tenths of all tokens takes, with up to four epochs of what is scarce."""
    return mix_documents(_documents(spark, sf_dir), 0.9, 4).select("doc_id", "lang", "source", F.col("epoch").cast("long").alias("epoch"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and the verdict of the learned rules."""
    judged = judge_quality(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    found = search(build_index(_documents(spark, sf_dir)), _table(spark, sf_dir, "benchmark"), k=50)
    return found.select(F.col("query_id").alias("item_id"), "rank", "doc_id", "score")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings in eight parts of sixteen entries, and what they lose."""
    coded, codebooks = fit_and_encode(_table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return with_main_text(_table(spark, sf_dir, "pages"), text_col="text").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {
    f.__name__: f
    for f in (op1_sharding, op2_substring_dedup, op3_packing, op4_toxicity, op5_warc, op6_fingerprints, op7_near_dedup, op8_url_filters,
              op9_mixing, op10_quality_rules, op11_lexical_search, op12_vector_codes, op13_main_text)
}


def _case(column: str, values: dict[str, int | str], other: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items()) + f" ELSE {other} END"


def _shares(level: str, parents: list[str], weight: str, above: str) -> str:
    """SQL for one level of the tree: nodes filled by capacity to weight, the rest shared by weight."""
    path = ", ".join([*parents, level])
    family = f"PARTITION BY {', '.join(parents)}" if parents else ""
    using = f"JOIN {above} USING ({', '.join(parents)})" if parents else f"CROSS JOIN {above}"
    order = f"{family} ORDER BY capacity::DOUBLE / weight::DOUBLE, {level}"
    return f"""
    {level}_nodes AS (SELECT {path}, sum(capacity) AS capacity, {weight} AS weight FROM leaves GROUP BY {path}),
    {level}_filled AS (SELECT *,
        coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
        sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead
        FROM {level}_nodes {using}),
    {level}_full AS (SELECT *, capacity * ahead <= weight * (budget - filled) AS is_full FROM {level}_filled),
    {level}_open AS (SELECT *,
        budget - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER ({family}) AS rest,
        sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({family}) AS open,
        sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM {level}_full),
    {level}_budgets AS (SELECT {path}, CASE WHEN is_full THEN capacity
        ELSE (rest * upto) // open - (rest * (upto - weight)) // open END AS budget FROM {level}_open)"""


_DOMAIN_SQL = "CASE " + " ".join(f"WHEN source IN ({', '.join(map(repr, s))}) THEN '{n}'" for n, s in DOMAINS.items()) + " ELSE 'web' END"
_HASH_SQL = f"md5('{MIX_SEED}:' || epochs || ':' || doc_id)"

OP9_SQL = f"""
WITH sized AS (SELECT doc_id, lang, source, {_DOMAIN_SQL} AS domain, coalesce(lang, '') AS language, coalesce(source, '') AS origin,
        len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS tokens FROM documents),
    leaves AS (SELECT domain, language, origin, sum(tokens) AS available, 4 * sum(tokens) AS capacity FROM sized GROUP BY ALL),
    total AS (SELECT floor(sum(available) * 0.9::DOUBLE)::BIGINT AS budget FROM leaves),
    {_shares("domain", [], _case("domain", DOMAIN_WEIGHTS, "1"), "total")},
    {_shares("language", ["domain"], _case("language", LANGUAGE_WEIGHTS, "1"), "domain_budgets")},
    {_shares("origin", ["domain", "language"], "1", "language_budgets")},
    plan AS (SELECT domain, language, origin, budget // available AS epochs, budget % available AS part
        FROM leaves JOIN origin_budgets USING (domain, language, origin) WHERE available > 0),
    ranked AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, language, origin ORDER BY {_HASH_SQL} RANGE BETWEEN UNBOUNDED PRECEDING
        AND CURRENT ROW) AS upto FROM sized JOIN plan USING (domain, language, origin))
SELECT doc_id, lang, source, unnest(range(epochs::BIGINT + CASE WHEN upto <= part THEN 1 ELSE 0 END)) AS epoch FROM ranked
"""

_TERM_SQL = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '{_TERM_SQL}') AS terms FROM documents),
    held AS (SELECT *, len(terms) AS n FROM docs WHERE len(terms) > 0),
    total AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM held),
    tfs AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM held) GROUP BY ALL),
    dfs AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, total GROUP BY term, nn),
    items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '{_TERM_SQL}')) AS term
        FROM benchmark),
    scored AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))))::BIGINT AS score
        FROM items JOIN dfs USING (term) JOIN tfs USING (term) JOIN held USING (r), total GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _op12_sql(rounds: int) -> str:
    """SQL that assigns and moves the entries round by round, every distance computed."""

    def assigned(number: int, books: str) -> str:
        return f"""
    far{number} AS MATERIALIZED (SELECT r, part, entry, sum((c.v - e.v) * (c.v - e.v))::BIGINT AS apart
        FROM cells c JOIN {books} e USING (part, pos) GROUP BY ALL),
    near{number} AS MATERIALIZED (SELECT r, part, entry, apart FROM far{number}
        QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY apart, entry) = 1)"""

    steps = [f"""
    books0 AS MATERIALIZED (SELECT part, pos, rank - 1 AS entry, v FROM cells JOIN ranks USING (r) WHERE rank <= 16)"""]
    for number in range(rounds):
        steps.append(assigned(number, f"books{number}"))
        steps.append(f"""
    moved{number} AS MATERIALIZED (SELECT part, pos, entry, floor(sum(v)::DOUBLE / count(*))::BIGINT AS v
        FROM near{number} JOIN cells USING (r, part) GROUP BY ALL),
    books{number + 1} AS MATERIALIZED (SELECT part, pos, entry, coalesce(m.v, b.v) AS v
        FROM books{number} b LEFT JOIN moved{number} m USING (part, pos, entry))""")
    steps.append(assigned(rounds, f"books{rounds}"))
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    ranks AS (SELECT r, row_number() OVER (ORDER BY vec_id) AS rank FROM kept),
    flat AS (SELECT r, len(embedding) // 8 AS width, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS place FROM kept),
    cells AS MATERIALIZED (SELECT r, place // width AS part, place % width AS pos, floor(x::DOUBLE * 4096)::BIGINT AS v FROM flat),
    {",".join(steps)},
    digest AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM books{rounds}),
    coded AS (SELECT r, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(apart)::BIGINT AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN kept USING (r), digest
"""


# On the given pages the article is what stands in the element of that name; its only inline tag is ``b``.
_STRIPPED = "regexp_replace(regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '</?b>', '', 'g'), '<[^>]*>', ' ', 'g')"
for _name, _char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
    _STRIPPED = f"regexp_replace({_STRIPPED}, '&{_name};?', '{_char}', 'g')"
OP13_SQL = f"""
WITH texts AS (SELECT page_id, url, trim(regexp_replace({_STRIPPED}, '\\s+', ' ', 'g')) AS text FROM pages)
SELECT page_id, url, text, length(text) AS n_chars FROM texts
"""

ORACLES: dict[str, str] = {"op9_mixing": OP9_SQL, "op11_lexical_search": OP11_SQL, "op12_vector_codes": _op12_sql(6), "op13_main_text": OP13_SQL}
