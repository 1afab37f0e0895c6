"""One query for each operator, over its whole table and with its production parameters, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    bpe,
    edited,
    fingerprints,
    html_text,
    mixing,
    near_dedup,
    quality,
    sharding,
    spelling,
    token_counts,
    topk,
    toxicity,
    url_filter,
    whitening,
)
from barloom.llm.tables import stored, table

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECES_FILE = public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 24
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
MIX_WEIGHTS = [3, 1, 2]
MIX_SHARE = 1.5
MIX_MOST = 2.0


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), BPE_FILE).drop("text")
    decoded = bpe.decode(encoded, BPE_FILE)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    names = [str(i) for i in range(SHARDS + 1)]
    placed = sharding.assign(rows, "doc_id", dict.fromkeys(names[:-1], 1.0))
    grown = sharding.assign(placed, "doc_id", dict.fromkeys(names, 1.0), "grown_shard")
    slots = sharding.with_slots(grown, "shard")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels").select("doc_id", "toxic"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    scored = toxicity.score(docs, model).withColumn("held_out", held_out)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents").select("doc_id", "text"), PIECES_FILE)
    return counted.select("doc_id", "n_tokens")


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = edited.beside_edited(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_string(F.col("signature")).alias("fingerprint"),
        fingerprints.as_string(F.col("edited_signature")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        fingerprints.likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.fit(pages)).select("page_id", "url", "text", "n_chars")


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


def mix_targets(sizes: DataFrame) -> DataFrame:
    """Targets of the sources of ``source, size`` rows: weights 3, 1, 2, repeating, 150 % of all words, twice a source at most."""
    weights = F.array(*map(F.lit, MIX_WEIGHTS))
    return mixing.source_targets(
        sizes, lambda place: F.get(weights, F.pmod(place, F.lit(len(MIX_WEIGHTS)))), MIX_SHARE, MIX_MOST
    )


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    words = table(spark, folder, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    sizes = stored(words, "mix-sizes")
    targets = mix_targets(sizes)
    taken = mixing.with_source(sizes, targets)
    copies = mixing.copies(F.col("doc_id"), F.col("rate"), 9)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.groups(table(spark, folder, "documents").select("doc_id", "text"))


def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, folder, "documents").select("doc_id", "text")))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = whitening.scaled(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return whitening.whiten(vectors, whitening.fit(vectors))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_sharding": op2_sharding,
    "op3_toxicity": op3_toxicity,
    "op4_token_counts": op4_token_counts,
    "op5_url_filter": op5_url_filter,
    "op6_fingerprints": op6_fingerprints,
    "op7_html_text": op7_html_text,
    "op8_topk": op8_topk,
    "op9_mixing": op9_mixing,
    "op10_near_dedup": op10_near_dedup,
    "op11_quality_rules": op11_quality_rules,
    "op12_spelling": op12_spelling,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op11_quality_rules": r"""
with recursive split as (
    select row_number() over () as r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l
    from (select doc_id, coalesce(text, '') as t from documents)
), windows as (
    select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as x from (select r, w, unnest(range(1, len(w) - 1)) as i from split)
), repeated as (
    select r, count(distinct p) as n from (
        select r, unnest([i, i + 1, i + 2]) as p from (select r, i, count(*) over (partition by r, x) as c from windows) where c > 1
    ) group by r
), measured as (
    select doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
        coalesce(n, 0) as n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as n_same,
        len(list_filter(w, lambda x: not regexp_matches(x, '\p{L}'))) as n_other,
        len(regexp_extract_all(t, '\p{Lu}')) as n_capitals, len(regexp_extract_all(t, '[!?]{2}')) as n_marks,
        len(list_filter(w, lambda x: list_contains([""" + ", ".join(f"'{w}'" for w in quality.COMMON) + r"""], lower(x)))) as n_common
    from split left join repeated on split.r = repeated.r
), voted as (
    select *, case when n_words > 0 then [
        case when n_symbols / n_words >= 0.1 then -1 when n_symbols / n_words <= 0.02 then 1 else 0 end,
        case when n_repeat_words / n_words >= 0.3 then -1 when n_repeat_words / n_words <= 0.1 then 1 else 0 end,
        case when n_dup_lines / n_lines >= 0.3 then -1 when n_dup_lines / n_lines <= 0.05 then 1 else 0 end,
        case when n_same / n_words >= 0.1 then -1 when n_same / n_words <= 0.02 then 1 else 0 end,
        case when n_other / n_words >= 0.2 then -1 when n_other / n_words <= 0.05 then 1 else 0 end,
        case when n_capitals / word_chars >= 0.2 then -1 when n_capitals / word_chars <= 0.06 then 1 else 0 end,
        case when n_marks / n_words >= 0.1 then -1 when n_marks / n_words <= 0.02 then 1 else 0 end,
        case when 1 - (n_common + 3) / n_words >= 0.96::double then -1 when 1 - (n_common + 3) / n_words <= 0.9::double then 1 else 0 end,
        case when abs(word_chars / n_words - 6) >= 4 then -1 when abs(word_chars / n_words - 6) <= 2.5 then 1 else 0 end
    ] end as v from measured
), patterns as (
    select v, count(*) as n from voted where not base_failed group by v
), em(i, good, g, b) as (
    select 0, 0.75::double, [0.95::double for _ in range(9)], [0.3::double for _ in range(9)]
    union all
    select i + 1, good, g, b from (
        with scored as (
            select i, v, n, 1 / (1 + exp(-ln(good / (1 - good)) - list_sum([
                case v[j] when 1 then ln(g[j] / (1 - b[j])) when -1 then ln((1 - g[j]) / b[j]) else 0 end for j in range(1, 10)]))) as q
            from em, patterns where i < 100
        ), right_votes as (
            select i, j,
                (sum(if(v[j] = 1, n * q, 0)) + 19) / (sum(if(v[j] <> 0, n * q, 0)) + 20) as gj,
                (sum(if(v[j] = -1, n * (1 - q), 0)) + 6) / (sum(if(v[j] <> 0, n * (1 - q), 0)) + 20) as bj
            from scored, (select unnest(range(1, 10)) as j) group by i, j
        )
        select i, (select (sum(n * q) + 15) / (sum(n) + 20) from scored) as good, list(gj order by j) as g, list(bj order by j) as b
        from right_votes group by i
    )
), model as (
    select coalesce(max_by(good, i), 0.75) as good, max_by(g, i) as g, max_by(b, i) as b from em
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and 1 / (1 + exp(-ln(good / (1 - good)) - list_sum([
        case v[j] when 1 then ln(g[j] / (1 - b[j])) when -1 then ln((1 - g[j]) / b[j]) else 0 end for j in range(1, 10)]))) >= 0.5 as kept
from voted, model
""",
    "op12_spelling": r"""
with recursive powers(byte, step, rest) as (
    select byte, 0, byte::bigint from range(256) as bytes(byte)
    union all
    select byte, step + 1, xor(rest >> 1, (rest & 1) * 3988292384) from powers where step < 8
), crc_table as (
    select list(rest order by byte) as crc from powers where step = 8
), runs as (
    select coalesce(doc_id::varchar, '') as k, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
    from documents
), counted as (
    select k, run, count(*) as n from runs where length(run) >= 7 group by all
), hashed as (
    select run, n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(k || ':' || run))),
            lambda i: ('0x' || hex(encode(k || ':' || run))[2 * i + 1 : 2 * i + 2])::bigint)),
        lambda c, byte: xor(c >> 8, crc[1 + (xor(c, byte) & 255)])), 4294967295) as h
    from counted, crc_table
), lost as (
    select case when h % 31 = 0 then run[1 : h % length(run)] || run[h % length(run) + 2 :] else run end as word, n from hashed
), words as (
    select word, sum(n)::bigint as n from lost where length(word) >= 7 group by word having sum(n) >= 2
), gaps as (
    select word, n, unnest([(i, word[1 : i] || word[i + 2 :]) for i in range(length(word))]) as gap from words
), pairs as (
    select a.word as x, b.word as y, b.n as m from gaps a join gaps b on a.gap = b.gap and a.word <> b.word
    union
    select g.word, w.word, w.n from gaps g join words w on g.gap[2] = w.word
    union
    select w.word, g.word, g.n from gaps g join words w on g.gap[2] = w.word
), near as (
    select x, count(*) as n_near, max(m) as best_n, min_by(y, (-m, y)) as best from pairs group by x
), formed as (
    select word, n, coalesce(n_near, 0) as n_near, if(best_n >= 10 * n, best, null) as form, if(best_n >= 10 * n, best_n, null) as form_n
    from words left join near on word = x
), chain(word, reached, steps) as (
    select word, word, 0 from formed
    union all
    select chain.word, form, steps + 1 from chain join formed on chain.reached = formed.word where form is not null
)
select f.word, form, root, n, n_near, form_n
from formed f join (select word, max_by(reached, steps) as root from chain group by word) using (word)
""",
    "op8_topk": """
with scaled as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::hugeint) as v from embeddings
    where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id as vec_id, coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0)::bigint as score
    from scaled q join scaled c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
""",
    "op5_url_filter": r"""
with parts as (
    select page_id,
        translate(regexp_extract(coalesce(url, ''), '^[\s\S]*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '^[\s\S]*?://[^/?#]*([^?#]*)', 1) as path
    from pages
), rules(rh, rp, verdict) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), judged as (
    select page_id, host, path,
        (select arg_max(rh || rp, length(rh || rp)) from rules
            where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)) as rule
    from parts
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from judged left join rules on rule = rh || rp
""",
    "op10_near_dedup": r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
    from documents
), sets as (
    select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from words
), shingles as (
    select doc_id, len(s) as n, unnest(s) as shingle from sets
), links as (
    select a.doc_id as x, b.doc_id as y, count(*) as common, any_value(a.n) as size_x, any_value(b.n) as size_y
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
    group by 1, 2 having 100 * common >= 75 * (size_x + size_y - common)
), edges as (
    select x, y from links union all select y, x from links
), reached(root, doc_id) as (
    select doc_id, doc_id from documents
    union
    select root, y from reached join edges on x = reached.doc_id
), components as (
    select doc_id, min(root) as component_id from reached group by 1
)
select doc_id, len(s) as n_shingles, component_id, doc_id = component_id as kept from sets join components using (doc_id)
""",
}
