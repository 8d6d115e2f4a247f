"""Queries on duplicates, reports, the star schema, dashboards and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatescope.functions.cleaning import l2_to_cosine
from estatescope.operators import dashboards, dedup, merge, reports, semantic, star
from estatescope.sources.tables import load


#: Bytes of a large file in these tables; few of their files reach the pipeline's own limit.
LARGE = 1 << 20


def _on_files(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load(spark, sf_dir, "files"))

    run.__doc__ = fn.__doc__
    return run


def _on_star(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star.build(load(spark, sf_dir, "files")))

    run.__doc__ = fn.__doc__
    return run


def _natural(fn, *columns):
    """A dimension without its surrogate keys, which are hashes no SQL knows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load(spark, sf_dir, "files")).drop("directory_id", "parent_id", "filetype_id", "classification_id", "group_id")

    run.__doc__ = fn.__doc__
    return run


def directory_children(spark, sf_dir):
    """Parents and numbers of children, by the keys of the directory dimension."""
    return star.directory_children(star.dim_directory(load(spark, sf_dir, "files"))).drop("directory_id")


def fact_keys(spark, sf_dir):
    """Facts whose keys are followed back to the natural values of every dimension."""
    s = star.build(load(spark, sf_dir, "files"))
    facts = s.facts.select("file_id", "directory_id", "filetype_id", "classification_id", "group_id", "is_canonical", "text_chars_extracted")
    back = facts.join(s.directories.select("directory_id", "path", "parent_id"), "directory_id", "left").join(s.file_types, "filetype_id", "left")
    back = back.join(s.classes, "classification_id", "left").join(s.groups, "group_id", "left")
    above = s.directories.select(F.col("directory_id").alias("parent_id"), F.col("path").alias("parent_path"))
    return back.join(above, "parent_id", "left").select("file_id", "path", "parent_path", "file_type", "categoria", "canonical_id", "is_canonical", "text_chars_extracted")


def kpi_overview(spark, sf_dir):
    """Key figures over facts, dimensions and inventory."""
    files = load(spark, sf_dir, "files")
    return dashboards.kpis(star.build(files), files)


def _published(files: DataFrame) -> DataFrame:
    """An older state of the facts: most rows as they are, some with another hash or time."""
    f = star.fact_files(files).where("file_id % 5 <> 0")
    return f.withColumn("last_seen", F.when(F.col("file_id") % 7 == 0, F.col("first_seen")).otherwise(F.col("last_seen"))).withColumn(
        "xxhash64", F.when(F.col("file_id") % 11 == 0, F.lit("old")).otherwise(F.col("xxhash64"))
    ).withColumn("name", F.concat(F.lit("old_"), "name"))


def fact_files(spark, sf_dir):
    f = star.fact_files(load(spark, sf_dir, "files"))
    return f.select("file_id", "name", "file_type", "categoria", "canonical_id", "size_bytes", "is_pdf", "ocr_needed", "is_canonical", "sha256", "anio")


def fact_upsert(spark, sf_dir):
    """Facts after a second publication; known rows keep their name."""
    files = load(spark, sf_dir, "files")
    return star.upsert_facts(_published(files), star.fact_files(files)).select("file_id", "name", "xxhash64", "size_bytes")


def etl_changed_only(spark, sf_dir):
    """Files to publish again."""
    files = load(spark, sf_dir, "files")
    facts = star.fact_files(files).select(F.col("file_id").alias("id"), "xxhash64", "sha256", "last_seen")
    return merge.changed_only(facts, _published(files)).select("id")


def l2_similarity(spark, sf_dir):
    """Similarity for a distance that follows from the price of an order line."""
    d = F.col("l_discount") * 10
    return load(spark, sf_dir, "lineitem").groupBy(F.round(d, 6).alias("distance")).agg(F.count("*").alias("n")).withColumn("similarity", F.round(l2_to_cosine(F.col("distance")), 6))


def files_with_embeddings(spark, sf_dir):
    joined = semantic.files_with_embeddings(load(spark, sf_dir, "files"), load(spark, sf_dir, "file_embeddings"))
    return joined.select("id", "file_type", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("numbers"))


def knn_topk(spark, sf_dir):
    return semantic.knn_topk(load(spark, sf_dir, "files"), load(spark, sf_dir, "file_embeddings"))


def semantic_edges(spark, sf_dir):
    return semantic.semantic_edges(load(spark, sf_dir, "files"), load(spark, sf_dir, "file_embeddings"), 0.8)


def semantic_clusters(spark, sf_dir):
    """Connected clusters of all canonical files."""
    return semantic.connected_clusters(load(spark, sf_dir, "files"), load(spark, sf_dir, "file_embeddings"), 0.9)


def semantic_clusters_greedy(spark, sf_dir):
    """Order-dependent clusters, every canonical file a seed in id order."""
    files = load(spark, sf_dir, "files")
    return semantic.greedy_clusters(semantic.nearest_edges(files, load(spark, sf_dir, "file_embeddings"), 0.9), files)


QUERIES = {
    "duplicate_groups": _on_files(dedup.duplicate_groups), "duplicate_members": _on_files(dedup.duplicate_members), "duplicate_summary": _on_files(dedup.duplicate_summary),
    "hash_canonical": _on_files(dedup.hash_canonical), "choose_canonical": _on_files(dedup.choose_canonical), "compress_pointers": _on_files(dedup.compress_pointers),
    "audit_totals": _on_files(reports.audit_totals), "type_distribution": _on_files(reports.type_distribution),
    "depth_distribution": _on_files(reports.depth_distribution), "large_file_listing": _on_files(lambda files: reports.large_file_listing(files, LARGE)),
    "stacked_report": _on_files(reports.stacked_report),
    "dim_directory": _natural(star.dim_directory), "dim_filetype": _natural(star.dim_filetype), "dim_classification": _natural(star.dim_classification),
    "dim_canonical_group": _natural(star.dim_canonical_group), "directory_children": directory_children, "fact_keys": fact_keys, "fact_files": fact_files, "fact_file_excerpts": _on_files(star.fact_file_excerpts),
    "fact_upsert": fact_upsert, "etl_changed_only": etl_changed_only,
    "dash_directories": _on_star(dashboards.directories), "dash_filetypes": _on_star(dashboards.file_types),
    "dash_classification": _on_star(dashboards.classes), "dash_duplicates": _on_star(dashboards.duplicates), "dash_integrity": _on_star(dashboards.integrity),
    "dash_temporal": _on_star(dashboards.temporal), "dash_previews": _on_star(dashboards.previews), "dash_size_type": _on_star(dashboards.size_by_type),
    "kpi_overview": kpi_overview, "l2_to_cosine": l2_similarity, "files_with_embeddings": files_with_embeddings,
    "knn_topk": knn_topk, "semantic_edges": semantic_edges, "semantic_clusters": semantic_clusters,
    "semantic_clusters_greedy": semantic_clusters_greedy,
}

_N = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_S = r"coalesce(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '')"
_TYPE, _CLASS = (f"coalesce({_N.format(c)}, '{d}')" for c, d in (("file_type", star.NO_TYPE), ("categoria", star.NO_CLASS)))
_FACT = f"""(select id as file_id, {_S.format("file_name")} as name, full_path, {_TYPE} as file_type, {_CLASS} as categoria,
  canonical_id, size_bytes, coalesce(is_pdf, false) as is_pdf, coalesce(ocr_needed, false) as ocr_needed, coalesce(is_canonical, true) as is_canonical,
  {_N.format("xxhash64")} as xxhash64, {_N.format("sha256")} as sha256, coalesce(text_chars_extracted, 0) as text_chars_extracted, first_seen, last_seen, last_classified, {_S.format("anio")} as anio
  from files where hash_pending = false)"""
_M = "cast(count(*) as bigint) as files, cast(coalesce(sum(size_bytes), 0) as bigint) as bytes"
_PUB = f"""(select file_id, 'old_' || name as name, case when file_id % 11 = 0 then 'old' else xxhash64 end as xxhash64, sha256, size_bytes,
  case when file_id % 7 = 0 then first_seen else last_seen end as last_seen from {_FACT} where file_id % 5 <> 0)"""
_VEC = """(select file_id as id, any_value(embedding)::double[] as v from file_embeddings where len(embedding) = 384
  and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0)) group by file_id)"""
_UNIT = f"(select id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) as v from {_VEC})"
_NEAR = f"""select q.id, n.id as other, list_distance(q.v, n.v) as d from (select f.id, lower(coalesce(f.file_type, '')) as kind, u.v from files f join {_UNIT} u using (id) where f.id % 50 = 0) q
  join (select f.id, lower(f.file_type) as kind, u.v from files f join {_UNIT} u using (id) where f.canonical_id is null) n on n.kind is null or n.kind = q.kind"""

_PREFER = """coalesce(is_pdf, false) and not coalesce(ocr_needed, false) desc, coalesce(size_bytes, 0) desc, coalesce(modification_year, 0) desc, coalesce(depth, 0), f.id"""

SQL = {
    "semantic_clusters": f"""with recursive r as (select f.id, lower(f.file_type) as kind, u.v from files f join {_UNIT} u using (id) where f.canonical_id is null),
        e as (select a.id as a, b.id as b from r a join r b on a.id <> b.id and (a.kind = b.kind or a.kind is null or b.kind is null)
          and 1 - list_distance(a.v, b.v) * list_distance(a.v, b.v) / 2 >= 0.9),
        reach as (select a as x, a as root from e union select e.b, reach.root from reach join e on e.a = reach.x),
        g as (select x as id, min(root) as root from reach group by x),
        h as (select f.id, first_value(f.id) over (partition by g.root order by {_PREFER}) as head from g join files f on f.id = g.id)
        select id, id = head as is_canonical, case when id <> head then head end as canonical_id from h""",
    "duplicate_groups": """select xxhash64, sha256, cast(count(*) as bigint) as total, min(full_path) as first_path, list_extract(string_split(min(full_path), '/'), -1) as first_name,
        case when count(*) <= 100 then string_agg(full_path, '; ' order by full_path) end as paths from files where sha256 is not null group by xxhash64, sha256 having count(*) > 1""",
    "duplicate_members": """select xxhash64, sha256, full_path from files where sha256 is not null qualify count(*) over (partition by xxhash64, sha256) > 1""",
    "duplicate_summary": """select cast(count(*) as bigint) as groups, cast(coalesce(sum(n), 0) as bigint) as files, max(n) as largest, arg_max(p, row(n, p)) as largest_path
        from (select count(*) as n, min(full_path) as p from files where sha256 is not null group by xxhash64, sha256 having count(*) > 1)""",
    "hash_canonical": """select id, case when sha256 is null then is_canonical else id = low end as is_canonical,
        case when sha256 is null then canonical_id when id <> low then low end as canonical_id
        from (select *, min(id) over (partition by sha256) as low from files)""",
    "choose_canonical": """select sha256, cast(count(*) as bigint) as members, max(case when rn = 1 then id end) as canonical_id from (select sha256, id, row_number() over (partition by sha256
        order by coalesce(is_pdf, false) and not coalesce(ocr_needed, false) desc, coalesce(size_bytes, 0) desc, coalesce(modification_year, 0) desc, coalesce(depth, 0), id) as rn
        from files where sha256 is not null) group by sha256""",
    "compress_pointers": """with recursive e as (select id, canonical_id as t from files where canonical_id <> id and canonical_id in (select id from files)),
        walk as (select id, t, 1 as n, least(id, t) as low from e union all select w.id, e.t, n + 1, least(low, e.t) from walk w join e on e.id = w.t where n < 2000)
        select id, case when t in (select id from e) then low else t end as root from walk qualify row_number() over (partition by id order by n desc) = 1""",
    "audit_totals": """select cast(count(*) as bigint) as files, cast(count(*) filter (where is_pdf) as bigint) as pdfs,
        cast(count(*) filter (where is_pdf and ocr_needed) as bigint) as pdfs_to_ocr from files""",
    "type_distribution": "select file_type, cast(count(*) as bigint) as n from files group by file_type",
    "depth_distribution": "select depth, cast(count(*) as bigint) as n from files group by depth",
    "large_file_listing": f"select full_path, size_bytes from files where size_bytes >= {LARGE}",
    "stacked_report": """select 'totals' as section, 'files' as item, cast(count(*) as bigint) as value from files
        union all select 'totals', 'pdfs', count(*) filter (where is_pdf) from files union all select 'totals', 'pdfs_to_ocr', count(*) filter (where is_pdf and ocr_needed) from files
        union all select 'types', file_type, count(*) from files group by file_type union all select 'depths', cast(depth as varchar), count(*) from files group by depth
        union all select 'large_files', full_path, size_bytes from files where size_bytes >= 104857600""",
    "dim_directory": """select path, list_extract(a, -1) as name, nullif(array_to_string(a[1:len(a) - 1], '/'), '') as parent_path, cast(len(a) as integer) as depth,
        a[4] as level1, a[5] as level2, a[6] as level3, a[7] as level4, a[8] as level5
        from (select distinct array_to_string(p[1:i], '/') as path, p[1:i] as a from (select p, unnest(range(2, len(p) + 1)) as i from (select string_split(full_path, '/') as p from files)))
        where path not in ('', '.', '/')""",
    "dim_filetype": f"select distinct {_TYPE} as file_type from files",
    "dim_classification": f"select distinct {_CLASS} as categoria from files",
    "directory_children": """with d as (select distinct array_to_string(p[1:i], '/') as path, nullif(array_to_string(p[1:i - 1], '/'), '') as up
          from (select p, unnest(range(2, len(p) + 1)) as i from (select string_split(full_path, '/') as p from files))),
        n as (select up, count(*) as c from d where up is not null group by up)
        select d.path, list_extract(string_split(d.up, '/'), -1) as parent, cast(coalesce(n.c, 0) as bigint) as children from d left join n on n.up = d.path where d.path not in ('', '.', '/')""",
    "fact_keys": f"""select file_id, full_path as path, nullif(regexp_extract(full_path, '^(.*)/[^/]*$', 1), '') as parent_path, file_type, categoria, canonical_id,
        is_canonical, text_chars_extracted from {_FACT}""",
    "dim_canonical_group": "select distinct canonical_id from files where canonical_id is not null",
    "fact_files": f"select file_id, name, file_type, categoria, canonical_id, size_bytes, is_pdf, ocr_needed, is_canonical, sha256, anio from {_FACT}",
    "fact_file_excerpts": "select id as file_id, text_excerpt from files where hash_pending = false and text_excerpt <> ''",
    "fact_upsert": f"select n.file_id, coalesce(o.name, n.name) as name, n.xxhash64, n.size_bytes from {_FACT} n left join {_PUB} o using (file_id)",
    "etl_changed_only": f"""select n.file_id as id from {_FACT} n left join {_PUB} o using (file_id)
        where o.file_id is null or n.xxhash64 is distinct from o.xxhash64 or n.sha256 is distinct from o.sha256 or n.last_seen is distinct from o.last_seen""",
    "dash_directories": f"""select l1 as level1, l2 as level2, l3 as level3, l4 as level4, l5 as level5, cast(grouping(l1, l2, l3, l4, l5) as integer) as subtotal, {_M}
        from (select size_bytes, p[4] as l1, p[5] as l2, p[6] as l3, p[7] as l4, p[8] as l5 from (select size_bytes, string_split(full_path, '/') as p from {_FACT}))
        group by rollup(l1, l2, l3, l4, l5)""",
    "dash_filetypes": f"select file_type, {_M} from {_FACT} group by file_type",
    "dash_classification": f"select categoria, cast(cast(last_classified as date) as varchar) as day, {_M} from {_FACT} group by 1, 2",
    "dash_duplicates": f"""select canonical_id, cast(count(*) as bigint) as copies, cast(count(*) filter (where is_canonical) as bigint) as marked_canonical,
        round(100.0::double * count(*) / (select count(*) from {_FACT}), 6) as percent from {_FACT} where canonical_id is not null group by canonical_id""",
    "dash_integrity": f"""select xxhash64, sha256, cast(count(*) as bigint) as files, cast(coalesce(sum(size_bytes) - max(size_bytes), 0) as bigint) as bytes_to_free
        from {_FACT} where sha256 <> '' group by 1, 2 having count(*) > 1""",
    "dash_temporal": f"""select event, strftime(w, '%Y-%m-%d') as week, n as files, cast(n - lag(n) over (partition by event order by w) as bigint) as change,
        cast(sum(n) over (partition by event order by w) as bigint) as running from (select event, w, cast(count(*) as bigint) as n from ("""
    + " union all ".join(f"select '{e}' as event, date_trunc('week', {e}) as w from {_FACT}" for e in ("first_seen", "last_seen", "last_classified"))
    + ") where w is not null group by event, w)",
    "dash_previews": f"""select file_id, name as file_name, string_split(full_path, '/')[4] as level1, file_type, substring(x.text_excerpt, 1, 200) as preview
        from {_FACT} f join (select id, text_excerpt from files) x on x.id = f.file_id where x.text_excerpt <> ''""",
    "dash_size_type": f"""select file_type, categoria, level1, cast(grouping(file_type, categoria, level1) as integer) as subtotal, {_M}
        from (select *, string_split(full_path, '/')[4] as level1 from {_FACT}) group by cube(file_type, categoria, level1)""",
    "kpi_overview": f"""with f as (select * from {_FACT}), t as (select count(*) as files, cast(coalesce(sum(size_bytes), 0) as bigint) as bytes, count(canonical_id) as duplicates,
          count(*) filter (where categoria in ('', '{star.NO_CLASS}')) as unclassified, cast(coalesce(sum(text_chars_extracted), 0) as bigint) as characters,
          count(*) filter (where text_chars_extracted > 0) as with_text from f)
        select 'totals' as section, item, cast(value as bigint) as value from (unpivot t on files, bytes, duplicates, unclassified, characters, with_text into name item value value)
        union all select 'totals', 'ocr_pending', count(*) from files where ocr_needed and (text_excerpt is null or text_excerpt = '') and canonical_id is null
        union all select 'types', file_type, count(*) from f group by file_type""",
    "l2_to_cosine": """select round(cast(l_discount as double) * 10, 6) as distance, cast(count(*) as bigint) as n,
        round(greatest(-1.0::double, least(1.0::double, 1.0::double - round(cast(l_discount as double) * 10, 6) * round(cast(l_discount as double) * 10, 6) / 2)), 6) as similarity from lineitem group by 1""",
    "files_with_embeddings": "select f.id, f.file_type, cast(len(e.embedding) as integer) as numbers from files f join file_embeddings e on e.file_id = f.id",
    "knn_topk": f"""select id, other, cast(rn as integer) as rank, round(greatest(-1.0::double, least(1.0::double, 1 - d * d / 2)), 6) as similarity
        from (select id, other, round(d, 9) as d, row_number() over (partition by id order by round(d, 9), other) as rn from ({_NEAR})) where rn <= 20""",
    "semantic_edges": f"select id, other, round(greatest(-1.0::double, least(1.0::double, 1 - d * d / 2)), 6) as similarity from ({_NEAR}) where id <> other and 1 - d * d / 2 >= 0.8",
}
