"""The operators as registered queries over the given tables, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import code_compression, edit_counts, fill_middle, packing, pii, toxicity
from tidemark.llm.common import table
from tidemark.llm.cover_tree import near_duplicates as near_vectors
from tidemark.llm.impact_search import top_k, whole_numbers
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix
from tidemark.llm.odd_sketch import near_duplicates as near_documents
from tidemark.llm.segment_sampling import sample_segmentations
from tidemark.llm.sharding import shard_documents
from tidemark.session import materialised


#: Vocabulary files; the folder is found by :func:`tokenizer`.
BYTE_PAIRS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


def tokenizer(name: str) -> tuple[bytes, str]:
    """A vocabulary file's bytes, read on the driver, and the pre-token pattern."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def op1_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op2_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer(BYTE_PAIRS)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = edit_counts.count_tokens(documents, ranks, pattern)
    after = edit_counts.recount(edit_counts.number_edits(counted), ranks, pattern)
    return after.select(
        "doc_id",
        "n_tokens",
        F.size("leaf_ends").cast("long").alias("n_leaves"),
        F.size("edits").cast("long").alias("n_edits"),
        "n_tokens_after",
        "chars_encoded",
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), most_repeats=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_numbers(table(spark, sf_dir, "embeddings"), scale=256)
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    flagged = toxicity.flag(documents, labels, threshold=0.3)
    return flagged.select("doc_id", "held_out", "score", "predicted")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(documents, min_words=1, near_words=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


def op7_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_semi_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [
        F.regexp_count("spans", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")
        for kind in pii.KINDS
    ]
    digest = F.sha2(F.col("base_spans"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, "spans")


def op9_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_documents(table(spark, sf_dir, "documents"), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_gumbel_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = tokenizer(PIECES)
    return sample_segmentations(table(spark, sf_dir, "documents"), model, k=2)


def op11_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, _ = tokenizer(WORDS)
    packed = packing.pack(table(spark, sf_dir, "documents"), words, end_id=1, longest=2048)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = fill_middle.fill_in_middle(documents, seed=1, rewritten=90, suffix_first=20)
    text = fill_middle.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"),
    )


def op13_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    coded, codebooks = code_compression.compress(vectors, parts=16, entries=64, rounds=2)
    summed = code_compression.with_group_error(
        materialised(coded), "label", "error", "label_error"
    )
    digest = F.lit(code_compression.digest(codebooks)).alias("codebooks_sha256")
    return summed.select("vec_id", "code", "error", "label_error", digest)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_cover_tree, op2_edit_counts, op3_mixing, op4_impact_search, op5_toxicity,
        op6_line_dedup, op7_histogram_sort, op8_semi_markov, op9_odd_sketch,
        op10_gumbel_segments, op11_binary_packing, op12_fill_in_middle, op13_code_compression,
    )
}

_VECTORS = """
vectors as (
    select vec_id, list_transform(embedding, lambda x: {component}) as e
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)"""

_VECTORS_OF_13 = """
vectors as (
    select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)"""
_NEAREST_OF_13 = """nearest{i} as (
    select vec_id, p, any_value(x.v) as v, min(struct_pack(d := list_sum(list_transform(
        list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, k := b.k)) as near
    from parts x join book{i} b using (p) group by vec_id, p
)"""
_ROUND_OF_13 = (
    _NEAREST_OF_13
    + """,
sums{i} as (
    select p, near.k as k, i, sum(v[i])::bigint as s, count(*) as n
    from nearest{i}, unnest(range(1, len(v) + 1)) as t(i) group by p, near.k, i
),
moved{i} as (
    select p, k, list((s - ((s % n) + n) % n) // n order by i) as v from sums{i} group by p, k
),
book{j} as (
    select p, k, coalesce(m.v, b.v) as v from book{i} b left join moved{i} m using (p, k)
)"""
)

#: SQL twins of the operators whose result SQL can say in a page.
ORACLE: dict[str, str] = {
    "op1_cover_tree": f"""
with recursive {_VECTORS.format(component="x::double")},
links as (
    select a.vec_id as a, b.vec_id as b
    from vectors a join vectors b on a.vec_id <> b.vec_id
    where list_sum(list_transform(a.e, lambda x: x * x)) > 0
      and list_sum(list_transform(b.e, lambda x: x * x)) > 0
      and list_cosine_similarity(a.e, b.e) >= 0.9
),
reached as (
    select a, b from links
    union
    select r.a, l.b from reached r join links l on l.a = r.b
)
select e.vec_id,
    (select count(*) from links l where l.a = e.vec_id) as n_links,
    coalesce((select least(min(r.b), e.vec_id) from reached r where r.a = e.vec_id), e.vec_id)
        as component_id,
    coalesce((select min(r.b) >= e.vec_id from reached r where r.a = e.vec_id), true) as kept
from embeddings e""",
    "op3_mixing": r"""
with sized as (
    select doc_id, source, md5(concat_ws('|', doc_id::varchar, text)) as key,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
    from documents
),
sources as (
    select source, sum(size)::bigint as source_size,
        (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
    from sized group by source
),
levels as (
    select *, source_size * 3 as cap,
        row_number() over filling as place,
        (sum(source_size) over () - coalesce(sum(source_size * 3) over (
            filling rows between unbounded preceding and 1 preceding), 0))::double
        / sum(weight) over (filling rows between current row and unbounded following) as level
    from sources
    window filling as (order by source_size * 3 / weight::double, source nulls last)
),
targets as (
    select source, source_size, least(cap::double, weight * (
        select arg_min(level, place) from levels where level <= cap / weight::double)) as target
    from levels
),
placed as (
    select s.doc_id, s.size, t.source_size, t.target,
        floor(t.target + 0.5)::bigint as budget,
        coalesce(sum(s.size) over (partition by s.source order by s.key, s.doc_id
            rows between unbounded preceding and 1 preceding), 0)::bigint as earlier
    from sized s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
    (case when source_size = 0 then 0 else budget // source_size * size
        + greatest(0, least(size, budget % source_size - earlier)) end)::bigint as taken
from placed""",
    "op4_impact_search": f"""
with {_VECTORS.format(component="floor(256 * x::double)::bigint")},
scored as (
    select q.vec_id as query_id, v.vec_id,
        list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]))::bigint as score
    from vectors q join vectors v on q.vec_id <> v.vec_id
    where q.vec_id % 50 = 0
)
select query_id,
    row_number() over (partition by query_id order by score desc, vec_id)::integer as rank,
    vec_id, score
from scored
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5""",
    "op12_fill_in_middle": """
with hashed as (
    select doc_id, coalesce(text, '') as text, length(coalesce(text, ''))::bigint as n,
        sha256('1:' || coalesce(doc_id::varchar, '')) as h
    from documents
),
drawn as (
    select *,
        ('0x' || h[1:8])::bigint % (n + 1) as a, ('0x' || h[9:16])::bigint % (n + 1) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>')
                or contains(text, '<M>') or ('0x' || h[17:24])::bigint % 100 >= 90 then 'plain'
            when ('0x' || h[25:32])::bigint % 100 < 20 then 'spm' else 'psm' end as form
    from hashed
),
cut as (
    select *, least(a, b) as p, greatest(a, b) - least(a, b) as m,
        '<P>' || substring(text, 1, least(a, b)) as prefix,
        '<M>' || substring(text, least(a, b) + 1, greatest(a, b) - least(a, b)) as middle,
        '<S>' || substring(text, greatest(a, b) + 1, n) as suffix
    from drawn
)
select doc_id, n, form,
    case when form <> 'plain' then p end as prefix_chars,
    case when form <> 'plain' then m end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then prefix || suffix || middle
        else suffix || prefix || middle end) as output_sha256,
    sha256(text) as restored_sha256
from cut""",
    "op13_code_compression": f"""
with {_VECTORS_OF_13},
parts as (
    select vec_id, label, p, e[p * (len(e) // 16) + 1 : (p + 1) * (len(e) // 16)] as v
    from vectors, range(16) as t(p)
),
first as (select vec_id, row_number() over (order by vec_id) - 1 as k from vectors
    order by vec_id limit 64),
book0 as (select p, k, v from parts join first using (vec_id)),
{_ROUND_OF_13.format(i=0, j=1)},
{_ROUND_OF_13.format(i=1, j=2)},
{_NEAREST_OF_13.format(i=2)},
coded as (
    select vec_id, string_agg(printf('%02x', near.k), '' order by p) as code,
        sum(near.d)::bigint as error
    from nearest2 group by vec_id
)
select vec_id, code, error,
    (sum(error) over (partition by label))::bigint as label_error,
    (select sha256(string_agg(array_to_string(v, ','), ',' order by p, k)) from book2)
        as codebooks_sha256
from coded join vectors using (vec_id)""",
}
