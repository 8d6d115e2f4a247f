"""Registered training-data queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatescope.llm import components, encode, encoding_repair, mixing, near_duplicates, neighbours, scan_repair, splitting, survivorship
from estatescope.sources.tables import load


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Representative of every group of files with one content."""
    return survivorship.representatives(load(spark, sf_dir, "files"))


def p1_golden_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record of every group, built field by field."""
    return survivorship.golden_records(load(spark, sf_dir, "files"))


def _repair(spark: SparkSession, sf_dir: str) -> encoding_repair.EncodingRepair:
    return encoding_repair.EncodingRepair(load(spark, sf_dir, "files"), "id", ("text_excerpt", "full_path"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with a passage garbled by wrong decoding."""
    return _repair(spark, sf_dir).found()


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled values with the original text given back."""
    return _repair(spark, sf_dir).restored()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of files of which one is among the five most similar of the other."""
    return neighbours.similar_pairs(load(spark, sf_dir, "file_embeddings"), 5)


def p3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most similar files of every file, with similarity and place."""
    return neighbours.nearest(load(spark, sf_dir, "file_embeddings"), 5).withColumn("similarity", F.round("similarity", 6))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose excerpt has a trace of scanning."""
    return scan_repair.ScanRepair(load(spark, sf_dir, "files")).found()


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces of scanning and the excerpt repaired into paragraphs."""
    return scan_repair.ScanRepair(load(spark, sf_dir, "files")).repaired()


def _versions(spark: SparkSession, sf_dir: str) -> near_duplicates.NearDuplicates:
    return near_duplicates.NearDuplicates(
        load(spark, sf_dir, "files"), width=3, threshold=0.5, least_words=20, bands=50, rows_per_band=3
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of files with different excerpts that share half of their word triples."""
    return _versions(spark, sf_dir).pairs()


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, class of copies and number of links of every excerpt."""
    return _versions(spark, sf_dir).groups()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group identifier of every linked file."""
    return components.linked_files(load(spark, sf_dir, "files"), load(spark, sf_dir, "match_pairs"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode.encode(load(spark, sf_dir, "documents"))


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every document, decoded from its token ids."""
    return encode.decode(encode.encode(load(spark, sf_dir, "documents")))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture: copies of documents in global random order."""
    return mixing.mix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets")).copies


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares the mixture reaches beside the targets."""
    return mixing.mix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets")).shares


def p9_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of a mixture as large as the listed sources together, where scarce sources fall short."""
    return mixing.mix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"), total_tokens="available").shares


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that had to be cut: those with a second piece."""
    return splitting.split(load(spark, sf_dir, "documents"), with_text=False).where("piece = 1").select("doc_id").distinct()


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the documents over the limit."""
    return splitting.split(load(spark, sf_dir, "documents"))


QUERIES = {
    "p1_found": p1_found, "p1_golden_records": p1_golden_records, "p2_found": p2_found,
    "p2_restored": p2_restored, "p3_found": p3_found, "p3_neighbours": p3_neighbours, "p4_found": p4_found,
    "p4_repaired": p4_repaired, "p5_found": p5_found,
    "p5_groups": p5_groups, "p7_found": p7_found, "p8_ids": p8_ids, "p8_decoded": p8_decoded,
    "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p9_budget": p9_budget, "p10_found": p10_found, "p10_pieces": p10_pieces,
}

_DIGEST = r"regexp_replace(regexp_replace(lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')), '^(?:sha-?256|0x)\s*[:=\-]?\s*', ''), '[\s:\-_]', '', 'g')"
_HASHED = f"""select *, case when size_bytes >= 0 then size_bytes end as size_ok,
    case when modification_year > 0 and modification_year <= year(last_seen) then modification_year end as year_ok
  from (select *, {_DIGEST} as digest from files) where regexp_full_match(digest, '[0-9a-f]{{64}}')"""
_RANK = """coalesce(is_pdf, false) and not coalesce(ocr_needed, false) desc, coalesce(size_ok, 0) desc,
    coalesce(year_ok, 0) desc, coalesce(depth, 0), id"""


def _best(value: str, name: str) -> str:
    order = f"{value} is not null, case when is_pdf = (file_type = '.pdf') then 1 else 0 end, last_seen, {value}"
    return f"arg_max(struct_pack(v := {value}), row({order})).v as {name}"


_NEAR = """with v as (select file_id as id, min(embedding)::double[] as e from file_embeddings where len(embedding) = 384
            and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0)) group by 1),
        r as (select a.id as a, b.id as b, list_cosine_similarity(a.e, b.e) as s,
            row_number() over (partition by a.id order by list_cosine_similarity(a.e, b.e) desc, b.id) as place from v a join v b on a.id <> b.id)"""
_VERSIONS = r"""
        w as (select id, list_filter(regexp_split_to_array(lower(text_excerpt), '[ \t\n\f\r]+'), lambda x: x <> '') as ws, text_excerpt as t
                   from files where text_excerpt is not null),
        d as (select min(id) as rep, t, any_value(ws) as ws from w where len(ws) >= 20 group by t),
        g as (select distinct rep, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) as g from d),
        n as (select rep, count(*) as n from g group by rep),
        c as (select a.rep as a, b.rep as b, count(*) as s from g a join g b on a.g = b.g and a.rep < b.rep group by 1, 2),
        p as (select a, b from c join n x on x.rep = a join n y on y.rep = b where s >= 0.5 * (x.n + y.n - s))"""

SQL = {
    "p3_found": f"{_NEAR} select distinct least(a, b) as id_a, greatest(a, b) as id_b from r where place <= 5",
    "p3_neighbours": f"{_NEAR} select a as file_id, b as other, round(s, 6) as similarity, cast(place as integer) as place from r where place <= 5",
    "p5_found": f"""with {_VERSIONS}, m as (select d.rep, w.id from d join w on w.t = d.t)
        select least(x.id, y.id) as id_a, greatest(x.id, y.id) as id_b from p join m x on x.rep = p.a join m y on y.rep = p.b""",
    # texts of fewer characters than 20 words take are in no class
    "p5_groups": f"""with recursive {_VERSIONS}, ends as (select a as u, b as v from p union all select b, a from p),
        reach as (select u as x, u as root from ends union select e.v, r.root from reach r join ends e on e.u = r.x),
        h as (select x, min(root) as root from reach group by x), l as (select u, count(*) as n from ends group by u),
        m as (select id, min(id) over (partition by t) as rep from w where length(t) >= 39)
        select m.id, coalesce(h.root, m.rep) as group_id, m.rep as class_id, cast(coalesce(l.n, 0) as bigint) as links
        from m left join h on h.x = m.rep left join l on l.u = m.rep""",
    "p8_decoded": "select doc_id, coalesce(text, '') as text from documents",
    "p1_found": f"""
        select min(id) as group_id, max(case when rn = 1 then id end) as survivor_id from (
          select digest, id, row_number() over (partition by digest order by {_RANK}) as rn from ({_HASHED}))
        group by digest having count(*) > 1""",
    "p1_golden_records": f"""
        select min(id) as group_id, max(case when rn = 1 then id end) as survivor_id, {_best("is_pdf", "is_pdf")},
          {_best("ocr_needed", "ocr_needed")}, {_best("size_ok", "size_bytes")}, {_best("year_ok", "modification_year")}, {_best("depth", "depth")}
        from (select *, row_number() over (partition by digest order by {_RANK}) as rn from ({_HASHED}))
        group by digest having count(*) > 1""",
    "p7_found": """
        with recursive ids as (select distinct id from files),
        e0 as (select id as a, canonical_id as b from files union select file_id_a, file_id_b from match_pairs),
        e1 as (select a, b from e0 where a <> b and a in (select id from ids) and b in (select id from ids)),
        edges as (select a, b from e1 union select b, a from e1),
        reach as (select a as id, a as root from edges union select e.b, r.root from reach r join edges e on e.a = r.id)
        select min(root) as group_id, id from reach group by id""",
}
