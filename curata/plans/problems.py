"""Queries of the general operators over the project's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.operators import drift, hotkeys, packed, reject
from curata.schema import ALL, EXTRA, dotted
from curata.session import load

SKEWED = ["antigen_epitope", "antigen_species"]
PACKED = ["v_beta", "mhc_a", "j_alpha"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject.rejected_lines(load(spark, sf_dir, "chunk_lines")).select("line_id")


def p1_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject.rejected_lines(load(spark, sf_dir, "chunk_lines"))


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject.typed_records(load(spark, sf_dir, "chunk_lines"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotkeys.heavy_keys(load(spark, sf_dir, "receptor_records"), SKEWED).select("field_name", "key_value")


def _per_key(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    measures = {
        "n_rows": F.count("*"),
        "n_paired": F.count(F.when(F.col("cdr3_alpha").isNotNull() & F.col("cdr3_beta").isNotNull(), 1)),
        "sum_beta_length": F.sum(F.length("cdr3_beta")),
        "first_submitted": F.min("submitted_at"),
        "last_submitted": F.max("submitted_at"),
    }
    return hotkeys.per_key(
        load(spark, sf_dir, "receptor_records"), key, measures, {"n_references": "reference_id", "n_beta": "cdr3_beta"}
    )


def p2_per_epitope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_key(spark, sf_dir, "antigen_epitope")


def p2_per_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_key(spark, sf_dir, "antigen_species")


def p5_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.changes(load(spark, sf_dir, "feed_files"), load(spark, sf_dir, "feed_rows"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_changes(spark, sf_dir).select("file_id", "column_name", "change_kind")


def p5_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = drift.unified(load(spark, sf_dir, "feed_files"), load(spark, sf_dir, "feed_rows"))
    return table.withColumn("meta_subset_frequency", F.round("meta_subset_frequency", 9))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed.split_values(load(spark, sf_dir, "receptor_records"), load(spark, sf_dir, "reference_names"), PACKED)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_rejected, p1_records, p2_found, p2_per_epitope, p2_per_species, p5_found, p5_changes, p5_unified, p6_found)
}

_LINES = r"""
l AS (SELECT line_id, chunk_file, line_no, regexp_replace(raw_line, '\r+$', '') AS s FROM chunk_lines),
f AS (SELECT *, regexp_extract_all(s || chr(9), '("(?:[^"]|"")*"|[^"\t][^\t]*|)\t', 1) AS raw FROM l),
p AS (SELECT *, list_sum(list_transform(raw, lambda x: length(x) + 1)) = length(s) + 1 AS quotes_ok,
        list_transform(raw, lambda x: regexp_replace(CASE WHEN starts_with(x, '"') THEN replace(x[2:-2], '""', '"') ELSE x END, '^\s+|\s+$', '', 'g')) AS v FROM f),
h AS (SELECT chunk_file, arg_min(v, line_id) AS hv FROM p WHERE line_no = 1 GROUP BY 1),
b AS (SELECT p.*, h.hv, nullif(v[list_position(hv, 'cdr3.beta')], '') AS beta, nullif(v[list_position(hv, 'mhc.a')], '') AS mhc,
        nullif(v[list_position(hv, 'species')], '') AS species, nullif(v[list_position(hv, 'reference.id')], '') AS ref
      FROM p LEFT JOIN h USING (chunk_file) WHERE line_no <> 1 OR line_no IS NULL),
r AS (SELECT *, NOT quotes_ok OR len(v) <> len(hv) AS broken,
        NOT coalesce(beta IS NULL OR (length(beta) > 3 AND regexp_matches(beta, '^[ARNDCQEGHILKMFPSTWYV]+$')), false) AS bad_beta,
        NOT coalesce(mhc IS NULL OR NOT starts_with(mhc, 'HLA') OR regexp_matches(mhc, '^HLA-[A-Z]+[0-9]?\*[0-9]{2}(:[0-9]{2,3}){0,3}$'), false) AS bad_mhc,
        NOT coalesce(lower(species) IN ('homosapiens', 'musmusculus', 'rattusnorvegicus', 'macacamulatta'), false) AS bad_species,
        NOT coalesce(ref IS NULL OR starts_with(ref, 'PMID:') OR starts_with(ref, 'doi:') OR starts_with(ref, 'http://') OR starts_with(ref, 'https://') OR contains(lower(ref), 'unpublished'), false) AS bad_ref
      FROM b)
"""


def _per_key_sql(key: str) -> str:
    return f"""
SELECT {key}, count(*) AS n_rows, count(*) FILTER (cdr3_alpha IS NOT NULL AND cdr3_beta IS NOT NULL) AS n_paired,
  sum(length(cdr3_beta))::BIGINT AS sum_beta_length, min(submitted_at) AS first_submitted, max(submitted_at) AS last_submitted,
  count(DISTINCT reference_id) AS n_references, count(DISTINCT cdr3_beta) AS n_beta
FROM receptor_records WHERE {key} IS NOT NULL GROUP BY {key}
"""


_CHANGES = r"""
o AS (SELECT file_id, lag(file_id) OVER (PARTITION BY feed_name ORDER BY sent_at, file_id) AS prev FROM feed_files),
m AS (SELECT file_id, row_id, u.key AS name, u.kind, u.val FROM (
        SELECT file_id, row_id, unnest(list_transform(json_keys(row_json), lambda k: {
          'key': k,
          'kind': CASE json_type(row_json, '/' || replace(replace(k, '~', '~0'), '/', '~1')) WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN NULL WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'number' END,
          'val': json_extract(row_json, '/' || replace(replace(k, '~', '~0'), '/', '~1'))::VARCHAR})) AS u FROM feed_rows)),
s AS (SELECT file_id, name, coalesce(list_sort(list_distinct(list(kind) FILTER (kind IS NOT NULL))), []) AS kinds FROM m GROUP BY 1, 2),
n AS (SELECT o.file_id, s.name, s.kinds FROM o JOIN s USING (file_id) WHERE prev IS NOT NULL),
p AS (SELECT o.file_id, s.name, s.kinds FROM o JOIN s ON s.file_id = o.prev),
c AS (SELECT coalesce(n.file_id, p.file_id) AS file_id, coalesce(n.name, p.name) AS name, p.kinds AS ok, n.kinds AS nk,
        CASE WHEN p.name IS NULL THEN 'added' WHEN n.name IS NULL THEN 'removed' WHEN len(p.kinds) > 0 AND len(n.kinds) > 0 AND p.kinds <> n.kinds THEN 'retyped' END AS change
      FROM n FULL JOIN p ON n.file_id = p.file_id AND n.name = p.name),
k AS (SELECT file_id, rk, name, min(CASE WHEN kind IS NOT NULL THEN val END) AS val
      FROM (SELECT m.*, max(CASE WHEN name = 'record.key' THEN val END) OVER (PARTITION BY row_id) AS rk FROM m) GROUP BY 1, 2, 3),
sh AS (SELECT DISTINCT o.file_id, o.prev, x.rk FROM o JOIN k x ON x.file_id = o.prev JOIN k y ON y.file_id = o.file_id AND y.rk = x.rk),
q AS (SELECT g.file_id, g.name AS old_name, a.name AS new_name, count(*) FILTER (ka.val = kb.val) AS same, count(*) FILTER (ka.val IS DISTINCT FROM kb.val) AS unlike
      FROM c g JOIN c a ON g.file_id = a.file_id AND g.change = 'removed' AND a.change = 'added' JOIN sh ON sh.file_id = g.file_id
      LEFT JOIN k ka ON ka.file_id = sh.prev AND ka.name = g.name AND ka.rk = sh.rk LEFT JOIN k kb ON kb.file_id = g.file_id AND kb.name = a.name AND kb.rk = sh.rk
      GROUP BY 1, 2, 3),
t AS (SELECT *, row_number() OVER (PARTITION BY file_id, old_name ORDER BY same DESC, new_name) AS x, row_number() OVER (PARTITION BY file_id, new_name ORDER BY same DESC, old_name) AS y
      FROM q WHERE same > 0 AND unlike = 0),
rn AS (SELECT * FROM t WHERE x = 1 AND y = 1),
z AS (SELECT c.file_id, c.name AS column_name, CASE WHEN w.old_name IS NOT NULL THEN 'renamed' ELSE c.change END AS change_kind, w.old_name,
        array_to_string(ok, '|') AS old_types, array_to_string(nk, '|') AS new_types
      FROM c LEFT JOIN rn w ON w.file_id = c.file_id AND w.new_name = c.name AND c.change = 'added'
      LEFT JOIN rn v ON v.file_id = c.file_id AND v.old_name = c.name AND c.change = 'removed'
      WHERE c.change IS NOT NULL AND v.old_name IS NULL)
"""

_FIXED = {"record_key": "record.key", "cdr3_beta": "cdr3.beta", "species": "species", "antigen_epitope": "antigen.epitope", "antigen_species": "antigen.species", "reference_id": "reference.id"}
_TEXT = "CASE kind WHEN 'string' THEN json_extract_string(val, '$') ELSE val END"
_NAMES_OF = ", ".join(f"'{n}'" for n in _FIXED.values())
_UNIFIED = f"""
lk AS (SELECT DISTINCT 'f' AS target, name FROM m WHERE regexp_replace(lower(name), '[^a-z0-9]', '', 'g') = 'metasubsetfrequency' UNION SELECT 'c', name FROM m WHERE regexp_replace(lower(name), '[^a-z0-9]', '', 'g') = 'comment'
  UNION SELECT lk.target, CASE WHEN z.old_name = lk.name THEN z.column_name ELSE z.old_name END FROM lk JOIN z ON z.change_kind = 'renamed' AND lk.name IN (z.old_name, z.column_name)),
fq AS (SELECT row_id, arg_min(kind, m.name) AS kind, arg_min(val, m.name) AS val FROM m JOIN lk ON lk.name = m.name AND target = 'f' WHERE kind IS NOT NULL GROUP BY 1),
ft AS (SELECT row_id, kind, val, trim(CASE WHEN kind = 'string' THEN json_extract_string(val, '$') END) AS t FROM fq),
cm AS (SELECT row_id, arg_min(CASE kind WHEN 'object' THEN json_extract_string(val, '$.text') || ' (' || json_extract_string(val, '$.by') || ')' WHEN 'array' THEN json_extract_string(val, '$[0]') || ' (' || json_extract_string(val, '$[1]') || ')' ELSE {_TEXT} END, m.name) AS comment FROM m JOIN lk ON lk.name = m.name AND target = 'c' WHERE kind IS NOT NULL GROUP BY 1),
ot AS (SELECT row_id, '{{' || coalesce(string_agg(to_json(name)::VARCHAR || ':' || val, ',' ORDER BY name) FILTER (name NOT IN ({_NAMES_OF}) AND name NOT IN (SELECT name FROM lk)), '') || '}}' AS others,
    {', '.join(f"min({_TEXT}) FILTER (name = '{n}' AND kind IS NOT NULL) AS {c}" for c, n in _FIXED.items())} FROM m GROUP BY 1)
SELECT r.row_id, r.file_id, line_no, {', '.join(_FIXED)}, round(CASE ft.kind WHEN 'number' THEN val::DOUBLE WHEN 'array' THEN try_cast(json_extract_string(val, '$[0]') AS DOUBLE) / nullif(try_cast(json_extract_string(val, '$[1]') AS DOUBLE), 0)
    WHEN 'object' THEN try_cast(json_extract_string(val, '$.num') AS DOUBLE) / nullif(try_cast(json_extract_string(val, '$.den') AS DOUBLE), 0)
    ELSE CASE WHEN contains(t, '/') THEN try_cast(regexp_extract(t, '^([^/]*)/', 1) AS DOUBLE) / nullif(try_cast(regexp_extract(t, '^[^/]*/+([^/]*)', 1) AS DOUBLE), 0) WHEN ends_with(t, '%') THEN try_cast(regexp_replace(t, '%$', '') AS DOUBLE) / 100 ELSE try_cast(t AS DOUBLE) END END, 9) AS meta_subset_frequency,
  ft.kind AS frequency_branch, comment, others, feed_name, sent_at
FROM feed_rows r LEFT JOIN feed_files USING (file_id) LEFT JOIN ot ON ot.row_id = r.row_id LEFT JOIN ft ON ft.row_id = r.row_id LEFT JOIN cm ON cm.row_id = r.row_id"""

SQL: dict[str, str] = {
    "p1_found": f"WITH {_LINES} SELECT line_id FROM r WHERE hv IS NULL OR broken OR bad_beta OR bad_mhc OR bad_species OR bad_ref",
    "p1_records": f"""WITH {_LINES} SELECT line_id, chunk_file, line_no, {', '.join(f"nullif(v[list_position(hv, '{dotted(c)}')], '') AS {c}" for c in EXTRA[:1] + ALL + EXTRA[1:])}
      FROM r WHERE hv IS NOT NULL AND NOT (broken OR bad_beta OR bad_mhc OR bad_species OR bad_ref)""",
    "p1_rejected": f"""WITH {_LINES} SELECT line_id, chunk_file, line_no, concat_ws('; ',
        CASE WHEN hv IS NULL THEN 'no header' END, CASE WHEN quotes_ok AND len(v) <> len(hv) THEN 'field count' END, CASE WHEN NOT quotes_ok THEN 'broken quoting' END,
        CASE WHEN NOT broken AND bad_beta THEN 'bad cdr3.beta' END, CASE WHEN NOT broken AND bad_mhc THEN 'bad mhc.a' END,
        CASE WHEN NOT broken AND bad_species THEN 'bad species' END, CASE WHEN NOT broken AND bad_ref THEN 'bad reference.id' END) AS reasons
      FROM r WHERE hv IS NULL OR broken OR bad_beta OR bad_mhc OR bad_species OR bad_ref""",
    "p2_found": """
WITH c AS (SELECT 'antigen_epitope' AS field_name, antigen_epitope AS key_value, count(*) AS n FROM receptor_records GROUP BY 2
  UNION ALL SELECT 'antigen_species', antigen_species, count(*) FROM receptor_records GROUP BY 2)
SELECT field_name, key_value FROM c WHERE key_value IS NOT NULL AND n > 0.04 * (SELECT count(*) FROM receptor_records)""",
    "p2_per_epitope": _per_key_sql("antigen_epitope"),
    "p2_per_species": _per_key_sql("antigen_species"),
    "p5_found": f"WITH {_CHANGES} SELECT file_id, column_name, change_kind FROM z",
    "p5_unified": f"WITH RECURSIVE {_CHANGES}, {_UNIFIED}",
    "p5_changes": f"WITH {_CHANGES} SELECT * FROM z",
    "p6_found": r"""
WITH w AS (SELECT field_name, '(' || string_agg(regexp_escape(canonical_name), '|' ORDER BY length(canonical_name) DESC, canonical_name) || ')(\*[0-9]{2,3}(:[0-9]{2,3})*)?' AS pattern
  FROM reference_names WHERE field_name IN ('v_beta', 'mhc_a', 'j_alpha') GROUP BY 1),
t AS (SELECT record_id, 'v_beta' AS field_name, v_beta AS s FROM receptor_records UNION ALL SELECT record_id, 'mhc_a', mhc_a FROM receptor_records UNION ALL SELECT record_id, 'j_alpha', j_alpha FROM receptor_records),
v AS (SELECT record_id, field_name, regexp_extract_all(s, pattern) AS vs FROM t JOIN w USING (field_name) WHERE s IS NOT NULL)
SELECT record_id, field_name, unnest(range(1, len(vs) + 1))::INT AS value_pos, unnest(vs) AS value_text FROM v WHERE len(vs) > 1""",
}
