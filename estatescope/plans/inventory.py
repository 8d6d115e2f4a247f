"""Queries on scanned paths, cleaned values and pending work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.functions import cleaning, paths
from estatescope.operators import merge, pending
from estatescope.sources.tables import load


#: Bytes of a large file in these tables; few of their files reach the pipeline's own limit.
LARGE = 1 << 20


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "files")


def scan_project(spark, sf_dir):
    """Inventory columns that follow from a path."""
    p = F.col("full_path")
    return _files(spark, sf_dir).select(
        "id", paths.path_name(p).alias("name"), paths.extension(paths.path_name(p)).alias("ext"), paths.is_pdf(paths.extension(paths.path_name(p))).alias("pdf"),
        paths.path_parent(p).alias("parent"), paths.extension_of_path(p).alias("ext_bare"), paths.last_dot_part(p).alias("last_part"),
        paths.component_count(p).alias("components"),
    )


def path_depth(spark, sf_dir):
    return _files(spark, sf_dir).select("id", paths.path_depth(F.col("full_path"), 1).alias("depth"))


def directory_levels(spark, sf_dir):
    return _files(spark, sf_dir).select("id", *paths.directory_levels(F.col("full_path")))


def sanitize_text(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", cleaning.sanitize_text(F.col("text")).alias("clean"))


def excerpt_cap(spark, sf_dir):
    return load(spark, sf_dir, "documents").where("text is not null").select("doc_id", cleaning.excerpt_cap(F.col("text")).alias("excerpt"))


def safe_values(spark, sf_dir):
    """Cleaned text, integer and flag of every file."""
    return _files(spark, sf_dir).select(
        "id", cleaning.safe_str(F.col("proyecto")).alias("project"), cleaning.safe_int(F.col("anio")).alias("year"),
        cleaning.safe_bool(F.col("ocr_needed")).alias("ocr"), cleaning.safe_bool_text(F.col("anio")).alias("flag"),
    )


def csv_flag_parse(spark, sf_dir):
    """Flags of a CSV listing (path, yes/no text) put in by path; the listing of all files is written and read as CSV."""
    flag = F.when(F.col("id") % 3 == 0, " TRUE ").when(F.col("id") % 5 == 0, "yes").when(F.col("id") % 7 == 0, "1").otherwise("no")
    path = workspace.new_path(spark, "listing")
    _files(spark, sf_dir).where("full_path is not null").select("full_path", flag.alias("flag")).write.option("header", True).option("escape", '"').csv(path)
    listing = spark.read.option("header", True).option("escape", '"').schema("full_path string, flag string").csv(path)
    flags = listing.groupBy("full_path").agg(F.max(cleaning.truthy_flag(F.col("flag"))).alias("ocr_needed"))
    return merge.apply_flags_by_path(_files(spark, sf_dir).select("id", "full_path", "ocr_needed"), flags).select("id", "ocr_needed")


def classification_prompts(spark, sf_dir):
    """Length and checksum-free head of the requests for files to classify."""
    f = pending.pending_classify(_files(spark, sf_dir))
    p = cleaning.prompt(F.col("full_path"), F.col("file_type"), F.col("creation_year"), F.col("text_excerpt"))
    return f.select("id", p.alias("prompt"))


def _simple(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_files(spark, sf_dir)).select("id")

    run.__doc__ = f"Ids of {fn.__name__.replace('_', ' ')}."
    return run


def large_files(files: DataFrame) -> DataFrame:
    return pending.large_files(files, LARGE)


def pending_images(spark, sf_dir):
    return pending.pending_images(_files(spark, sf_dir), load(spark, sf_dir, "moondream_task_map")).select("id")


def pending_images_to_send(spark, sf_dir):
    return pending.pending_images(_files(spark, sf_dir), load(spark, sf_dir, "moondream_task_map"), canonical_only=False).select("id")


def next_batch(spark, sf_dir):
    return pending.next_batch(pending.pending_images(_files(spark, sf_dir), load(spark, sf_dir, "moondream_task_map"), False)).select("id", "full_path")


def pending_counts(spark, sf_dir):
    return pending.pending_counts(_files(spark, sf_dir), load(spark, sf_dir, "moondream_task_map"))


def distinct_on_hash(spark, sf_dir):
    return pending.first_per_hash(_files(spark, sf_dir)).select("id", "xxhash64")


def chunk_numbers(spark, sf_dir):
    return pending.chunk_numbers(_files(spark, sf_dir).select("id"), 500)


_CLOCK = "2025-01-01 00:00:00"
_SCAN_SQL = """select full_path, file_name || '' as file_name, file_type, case when id % 8 = 0 then size_bytes + 1 else size_bytes end as size_bytes,
    creation_year, modification_year, depth, is_pdf from files where id % 4 = 0
  union all select full_path || '.new', file_name || '.new', '.new', size_bytes, creation_year, modification_year, depth, is_pdf from files where id % 20 = 1"""


def scan_upsert(spark, sf_dir):
    """Second scan merged into the inventory."""
    f = _files(spark, sf_dir)
    scanned = spark.sql(_SCAN_SQL.replace("from files", "from {files}"), files=f)
    out = merge.scan_upsert(f, scanned, F.lit(_CLOCK).cast("timestamp_ntz"))
    return out.select("full_path", "file_name", "size_bytes", "modification_year", "hash_pending", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"), "action")


def apply_hashes(spark, sf_dir):
    f = _files(spark, sf_dir)
    new = f.where("hash_pending").select("id", F.concat(F.lit("x"), F.col("id").cast("string")).alias("xxhash64"), F.when(F.col("id") % 2 == 0, F.sha2("full_path", 256)).alias("sha256"))
    return merge.apply_hashes(f, new).select("id", "xxhash64", "sha256", "hash_pending")


def apply_results(spark, sf_dir):
    """OCR flags, texts and classes put back one after the other."""
    f = _files(spark, sf_dir).select("id", "ocr_needed", "text_excerpt", "text_chars_extracted", "categoria", "anio", "proyecto", "last_classified", "is_pdf")
    flags = f.where("is_pdf").select("id", F.when(F.col("id") % 3 == 0, True).alias("ocr_needed"))
    texts = f.where("text_excerpt is null and id % 2 = 0").select("id", F.lit("").alias("text_excerpt"), F.lit(0).alias("text_chars_extracted"))
    classes = f.where("categoria is null").select("id", F.lit("Otro").alias("categoria"), F.lit("2020").alias("anio"), F.lit(None).cast("string").alias("proyecto"))
    out = merge.apply_texts(merge.mark_ocr_needed(merge.apply_ocr_flags(f, flags), f.where("id % 11 = 0")), texts)
    out = merge.apply_classes(out, classes, F.lit(_CLOCK).cast("timestamp_ntz"))
    return out.select("id", "ocr_needed", "text_excerpt", "text_chars_extracted", "categoria", "anio", "proyecto")


def insert_if_absent(spark, sf_dir):
    """Tasks entered for correlation ids that have none yet."""
    known = load(spark, sf_dir, "moondream_task_map").select("correlation_id", "file_id")
    new = load(spark, sf_dir, "task_messages").select("correlation_id", F.col("delivery_id").alias("file_id"))
    return merge.insert_if_absent(known, new, "correlation_id", "file_id")


QUERIES = {
    "scan_project": scan_project, "path_depth": path_depth, "directory_levels": directory_levels, "sanitize_text": sanitize_text,
    "excerpt_cap": excerpt_cap, "safe_values": safe_values, "csv_flag_parse": csv_flag_parse, "classification_prompts": classification_prompts,
    "pending_pdf": _simple(pending.pending_pdf), "pending_hash": _simple(pending.pending_hash), "large_files": _simple(large_files),
    "pending_text": _simple(pending.pending_text), "pending_ocr": _simple(pending.pending_ocr), "pending_classify": _simple(pending.pending_classify),
    "image_candidates": _simple(pending.image_candidates), "undecided_pictures": _simple(pending.undecided_pictures), "pending_images": pending_images, "pending_images_to_send": pending_images_to_send,
    "next_batch": next_batch, "pending_counts": pending_counts, "distinct_on_hash": distinct_on_hash, "chunk_numbers": chunk_numbers,
    "scan_upsert": scan_upsert, "apply_hashes": apply_hashes, "apply_results": apply_results, "insert_if_absent": insert_if_absent,
}

_NAME = "list_extract(string_split(full_path, '/'), -1)"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_CLEAN = r"regexp_replace(coalesce({}, ''), '[\x00-\x09\x0b-\x1f\x7f]', ' ', 'g')"


def _capped(c: str, n: int) -> str:
    t = _CLEAN.format(c)
    return f"case when length({t}) > {n} then substring({t}, 1, {n}) || ' …[truncated]…' else {t} end"


_HASH = "(xxhash64 is null or sha256 is null or hash_pending)"
_OCR = "(ocr_needed and (text_excerpt is null or text_excerpt = '') and canonical_id is null)"
_CLASS = "(categoria is null and text_excerpt is not null and canonical_id is null)"
_CAPTION = "lower(file_type) in ('.png', '.jpg', '.jpeg', '.gif', '.bmp', '.tiff', '.webp')"
_UNSENT = "not exists (select 1 from moondream_task_map m where m.file_id = files.id)"
_DETECT = "('jpg', 'jpeg', 'png', 'tif', 'tiff', 'bmp')"
_DETECT_DOT = "('.jpg', '.jpeg', '.png', '.tif', '.tiff', '.bmp')"

SQL = {
    "scan_project": rf"""select id, {_NAME} as name, lower(regexp_extract({_NAME}, '^\.*[^.].*?(\.[^.]*)$', 1)) as ext,
        lower(regexp_extract({_NAME}, '^\.*[^.].*?(\.[^.]*)$', 1)) = '.pdf' as pdf, nullif(regexp_extract(full_path, '^(.*)/[^/]*$', 1), '') as parent,
        regexp_extract(full_path, '.+\.([^.]+)$', 1) as ext_bare, lower(list_extract(string_split(full_path, '.'), -1)) as last_part,
        cast(len(string_split(full_path, '/')) as integer) as components from files""",
    "path_depth": "select id, cast(length(full_path) - length(replace(full_path, '/', '')) - 1 as integer) as depth from files",
    "directory_levels": "select id, p[4] as level1, p[5] as level2, p[6] as level3, p[7] as level4, p[8] as level5 from (select id, string_split(full_path, '/') as p from files)",
    "sanitize_text": f"select doc_id, {_capped('text', 3000)} as clean from documents",
    "excerpt_cap": "select doc_id, substring(text, 1, 8000) as excerpt from documents where text is not null",
    "safe_values": f"""select id, coalesce({_STRIP.format("proyecto")}, '') as project, case when regexp_full_match(trim(anio), '[+-]?\\d+') then try_cast(anio as integer) end as year,
        coalesce(ocr_needed, false) as ocr, case when anio is null then false else lower(anio) in ('t', 'true', '1') end as flag from files""",
    "csv_flag_parse": "select id, id % 3 = 0 or id % 5 = 0 or id % 7 = 0 as ocr_needed from files",
    "classification_prompts": f"""select id, 'Classify the document and answer with JSON keys categoria, anio, proyecto.' || chr(10) || 'path: ' || {_capped("full_path", 500)}
        || chr(10) || 'type: ' || coalesce(file_type, '') || chr(10) || 'year: ' || coalesce(cast(creation_year as varchar), '') || chr(10) || 'text: '
        || {_capped("text_excerpt", 500)} as prompt from files where {_CLASS}""",
    "pending_pdf": "select id from files where is_pdf and ocr_needed is null",
    "pending_hash": f"select id from files where {_HASH}",
    "large_files": f"select id from files where size_bytes >= {LARGE}",
    "pending_text": "select id from files where text_excerpt is null",
    "pending_ocr": f"select id from files where {_OCR}",
    "pending_classify": f"select id from files where {_CLASS}",
    "image_candidates": rf"""select min(id) as id from files where (ocr_needed = false and (lower(regexp_extract(full_path, '.+\.([^.]+)$', 1)) in {_DETECT}))
        or lower(file_type) in {_DETECT_DOT} group by xxhash64""",
    "undecided_pictures": """select min(id) as id from files where ocr_needed = false and xxhash64 is not null
        and lower(list_extract(string_split(full_path, '.'), -1)) in ('jpg', 'jpeg', 'png', 'tif', 'tiff', 'bmp', 'webp') group by xxhash64""",
    "pending_images": f"select id from files where {_CAPTION} and canonical_id is null and {_UNSENT}",
    "pending_images_to_send": f"select id from files where {_CAPTION} and {_UNSENT}",
    "next_batch": f"select id, full_path from files where {_CAPTION} and {_UNSENT} order by id limit 500",
    "pending_counts": f"""select cast(count(*) filter (where {_HASH}) as bigint) as hash, cast(count(*) filter (where is_pdf and ocr_needed is null) as bigint) as pdf,
        cast(count(*) filter (where text_excerpt is null) as bigint) as text, cast(count(*) filter (where {_OCR}) as bigint) as ocr,
        cast(count(*) filter (where {_CLASS}) as bigint) as classify, cast(count(*) filter (where {_CAPTION} and canonical_id is null and {_UNSENT}) as bigint) as image,
        cast(count(*) filter (where hash_pending = false) as bigint) as etl from files""",
    "distinct_on_hash": "select id, xxhash64 from (select id, xxhash64, row_number() over (partition by xxhash64 order by id) as rn from files) where rn = 1",
    "chunk_numbers": "select id, cast((row_number() over (order by id) - 1) // 500 as bigint) as chunk from files",
    "scan_upsert": f"""with s as ({_SCAN_SQL})
        select coalesce(f.full_path, s.full_path) as full_path,
          case when f.id is null or s.size_bytes <> f.size_bytes or s.modification_year <> f.modification_year then s.file_name else f.file_name end as file_name,
          case when f.id is null or s.size_bytes <> f.size_bytes or s.modification_year <> f.modification_year then s.size_bytes else f.size_bytes end as size_bytes,
          case when f.id is null or s.size_bytes <> f.size_bytes or s.modification_year <> f.modification_year then s.modification_year else f.modification_year end as modification_year,
          case when f.id is null then true else f.hash_pending end as hash_pending,
          case when f.id is null or s.size_bytes <> f.size_bytes or s.modification_year <> f.modification_year then '{_CLOCK}'
            else strftime(f.last_seen, '%Y-%m-%d %H:%M:%S') end as last_seen,
          case when f.id is null then 'insert' when s.size_bytes <> f.size_bytes or s.modification_year <> f.modification_year then 'update' else 'keep' end as action
        from files f full outer join s on s.full_path = f.full_path""",
    "apply_hashes": """select id, case when hash_pending then 'x' || cast(id as varchar) else xxhash64 end as xxhash64,
        case when hash_pending and id % 2 = 0 then sha256(full_path) else sha256 end as sha256, case when hash_pending then false else hash_pending end as hash_pending from files""",
    "apply_results": """select id, case when id % 11 = 0 then true when is_pdf and id % 3 = 0 then true else ocr_needed end as ocr_needed,
        case when text_excerpt is null and id % 2 = 0 then '' else text_excerpt end as text_excerpt,
        case when text_excerpt is null and id % 2 = 0 then 0 else text_chars_extracted end as text_chars_extracted,
        coalesce(categoria, 'Otro') as categoria, case when categoria is null then '2020' else anio end as anio,
        case when categoria is null then null else proyecto end as proyecto from files""",
    "insert_if_absent": """select correlation_id, file_id from moondream_task_map union all
        select correlation_id, min(delivery_id) as file_id from task_messages where correlation_id is not null
          and correlation_id not in (select correlation_id from moondream_task_map where correlation_id is not null) group by correlation_id""",
}
