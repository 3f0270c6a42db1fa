"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsieve.llm import (
    attention_lm,
    collocations,
    embed_dedup,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    pii,
    quality_gam,
    quality_rules,
    suffix_dedup,
    warc,
)
from barsieve.llm.common import documents, importable
from barsieve.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines taken out that stand on too many documents of its source."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs).select("doc_id", "source", "n_lines", "n_dropped", "text")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near copies of every document."""
    return ngram_join.near_copies(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in the packed sequences."""
    return packing.pack(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from the labelled rows that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality_gam.classify(docs, docs, labels, keep=["doc_id"])
    held_out = F.coalesce(quality_gam.fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is taken out of every document because 400 bytes of it start elsewhere too."""
    found = suffix_dedup.without_repeats(documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"])
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    found = mixing.mix(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return found.select("doc_id", "source", "size", "source_size", "target", "taken")


def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language model's score of every document, learned from those that are not held out."""
    return attention_lm.score(documents(spark, sf_dir))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document."""
    return pii.personal_data(documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"])


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links and component of every vector."""
    return embed_dedup.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules' counts and verdict for every document; the regression learns from the rows that op4 learns from."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_rules.train(docs, labels, quality_gam.fold(F.col("doc_id"), 5) != 0)
    return quality_rules.judge(docs, model, keep=["doc_id"])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, some of which are first made to end in one, and digests of what is left."""
    docs = periodic_runs.with_periodic_tails(documents(spark, sf_dir).select("doc_id", "text"))
    found = periodic_runs.with_runs(docs, keep=["doc_id"])
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.col("n_runs") > 0, "\n").otherwise(""))
    longest = ["start", "length", "period", "exponent_milli"]
    runs_sha256, collapsed_sha256 = F.sha2(listed, 256), F.sha2("collapsed", 256)
    return found.select(
        "doc_id", "n_runs", *longest, runs_sha256.alias("runs_sha256"), collapsed_sha256.alias("collapsed_sha256")
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words stand together most against chance."""
    return collocations.collocations(documents(spark, sf_dir).select("lang", "text"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives, and what these say of every page."""
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.planned(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)
    found = warc.read_archives(spark, path, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = rf"""
with lines as (
    select source, unnest(list_distinct(string_split(text, chr(10)))) as line from documents
), counts as (
    select source, line, count(*) as n from lines
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by source, line
), totals as (
    select source, count(*) as pages from documents group by source
), bad as (
    select c.source, list(c.line) as bad from counts c join totals t on c.source is not distinct from t.source
    where n >= {line_dedup.MIN_PAGES} and n > {line_dedup.RATIO} * pages group by c.source
), cut as (
    select d.doc_id, d.source, d.text, b.bad, string_split(d.text, chr(10)) as parts
    from documents d left join bad b on d.source is not distinct from b.source
), kept as (
    select *, case when bad is null then parts else list_filter(parts, lambda x: not list_contains(bad, x)) end as rest
    from cut
)
select doc_id, source, coalesce(len(parts), 0)::bigint as n_lines,
    (coalesce(len(parts), 0) - coalesce(len(rest), 0))::bigint as n_dropped,
    case when text is null or bad is null then text else array_to_string(rest, chr(10)) end as text
from kept
"""


OP2_SQL = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), sets as (
    select doc_id, list_distinct(case
        when len(w) = 0 then []
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from words
), shingles as (
    select doc_id, len(s) as n, unnest(s) as shingle from sets where doc_id is not null
), links as (
    select a.doc_id as a, b.doc_id as b
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n
    having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach as (
    select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a
), least as (
    select a, min(b) as low from reach group by a
)
select doc_id, len(s)::bigint as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id
from sets left join least on doc_id = a
"""

OP9_SQL = r"""
with recursive sound as (
    select vec_id, embedding::double[] as v from embeddings
    where vec_id is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
    select a.vec_id as a, b.vec_id as b from sound a join sound b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.9
), counted as (
    select a, count(*) as n from links group by a
), reach as (
    select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a
), least as (
    select a, min(b) as low from reach group by a
)
select vec_id, coalesce(n, 0)::bigint as n_links, least(vec_id, coalesce(low, vec_id)) as component_id,
    coalesce(vec_id = least(vec_id, coalesce(low, vec_id)), true) as kept
from embeddings left join counted on vec_id = counted.a left join least on vec_id = least.a
"""

OP12_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), words as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), totals as (
    select lang, sum(len(w))::bigint as n from words group by lang
), phrases as (
    select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
    from words, unnest(range(1, 6)) as lengths(m) where len(w) >= m
), counted as (
    select lang, m, phrase, count(*) as a from phrases group by lang, m, phrase having count(*) >= 100
), listed as (
    select *, string_split(phrase, ' ') as w from counted where m > 1
), inner_phrases as (
    select lang, a, unnest(flatten(list_transform(range(2, m), lambda k: list_transform(range(1, m - k + 2),
        lambda i: array_to_string(w[i:i + k - 1], ' '))))) as phrase
    from listed where m > 2
), above as (
    select lang, phrase, max(a) as most from inner_phrases group by lang, phrase
), alone as (
    select l.* from listed l left join above b on l.lang = b.lang and l.phrase = b.phrase
    where b.most is null or 100 * b.most < 100 * l.a
), cuts as (
    select lang, phrase, a, k, array_to_string(w[1:k], ' ') as x, array_to_string(w[k + 1:], ' ') as y
    from alone, unnest(range(1, 5)) as places(k) where k < m
), scored as (
    select c.lang, c.phrase, c.a, k, x.a as l, y.a as r, n,
        ((1000::hugeint * c.a * n) // (x.a::hugeint * y.a))::bigint as score
    from cuts c join totals t on c.lang = t.lang
        join counted x on c.lang = x.lang and c.x = x.phrase join counted y on c.lang = y.lang and c.y = y.phrase
), best as (
    select *, row_number() over (partition by lang, phrase order by score, k) as cut from scored
), ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best where cut = 1
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""

OP13_SQL = r"""
with payloads as (
    select page_id, coalesce(html, '') as payload, max(page_id) over (partition by coalesce(html, '')) as head from pages
), hashed as (
    select *, sha1(payload) as hex from payloads
), bits as (
    select *, array_to_string(list_transform(range(1, 41),
        lambda i: right('000' || bin(instr('0123456789abcdef', substr(hex, i, 1)) - 1), 4)), '') as b
    from hashed
)
select page_id, strlen(payload)::bigint as payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + list_sum(list_transform(range(1, 6), lambda j: substr(b, i * 5 + j, 1)::int * (1 << (5 - j)::int)))::int, 1)),
        '') as payload_digest,
    case when page_id is not distinct from head then 'response' else 'revisit' end as record_type,
    case when page_id is distinct from head then head end as refers_to
from bits
"""


def _with_package(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


def all_queries() -> dict[str, Query]:
    named = [
        op1_line_dedup,
        op2_ngram_join,
        op3_packing,
        op4_quality_classifier,
        op5_suffix_dedup,
        op6_mixing,
        op7_attention_lm,
        op8_personal_data,
        op9_embedding_dedup,
        op10_quality_rules,
        op11_periodic_runs,
        op12_collocations,
        op13_warc,
    ]
    return {q.__name__: _with_package(q) for q in named}


def all_sql() -> dict[str, str]:
    """SQL for queries over `documents` and `embeddings`."""
    return {
        "op1_line_dedup": OP1_SQL,
        "op2_ngram_join": OP2_SQL,
        "op9_embedding_dedup": OP9_SQL,
        "op12_collocations": OP12_SQL,
    }


def pages_sql() -> dict[str, str]:
    """SQL for queries over `pages`."""
    return {"op13_warc": OP13_SQL}
