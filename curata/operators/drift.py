"""Schemas that drift between the files of a feed: change list and one consistent table.

Tagged-union inference: each file's schema is the set of alternatives (name, JSON type) seen at its
top level. Schemas of single rows are fused by a union per file; consecutive files are compared by
name, by type alternatives and, for renames, by the values of the records that both files hold.
Conflicting alternatives are split into typed branches with one canonical conversion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.session import checkpointed, lookup_join

RECORD_KEY = "record.key"

# The two fields of the unified table that drift, as letters and digits.
FREQUENCY, COMMENT = "metasubsetfrequency", "comment"

#: Most names that are linked to one another on the driver.
MAX_LINKS = 100_000


def branches(rows: DataFrame) -> DataFrame:
    """Every top-level member of every row: file_id, row_id, line_no, name, value (JSON text), kind.

    ``kind`` is string, number, boolean, array, object or null. Rows that are no JSON object give
    nothing. Of a name that one object repeats, the JSON reader's last value holds; for this the
    session's setting for repeated keys is turned on, else such a row would be no object.
    """
    rows.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return members(documents(rows).select("file_id", "row_id", "line_no", "doc"))


def documents(rows: DataFrame) -> DataFrame:
    """Rows with their parsed ``doc`` in place of row_json; null where that is no JSON."""
    rows.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    kept = [c for c in rows.columns if c != "row_json"]
    return rows.select(*kept, F.try_parse_json("row_json").alias("doc"))


def kind_of(value: Column) -> Column:
    """JSON type of a variant."""
    shape = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return (
        F.when(shape == "VOID", "null")
        .when(shape == "STRING", "string")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "ARRAY", "array")
        .when(shape == "OBJECT", "object")
        .otherwise("number")
    )


def exploded(parsed: DataFrame) -> DataFrame:
    """Every member of every ``doc``: the other columns, key and value (a variant)."""
    kept = [c for c in parsed.columns if c != "doc"]
    return parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("doc").outer())).where("key is not null").select(*kept, "key", "value")  # no object, no key


def members(parsed: DataFrame) -> DataFrame:
    """Members as name, value (JSON text, null for null) and kind."""
    kept = [c for c in parsed.columns if c != "doc"]
    kind = kind_of(F.col("value"))
    return exploded(parsed).select(*kept, F.col("key").alias("name"), F.when(kind != "null", F.to_json("value")).alias("value"), kind.alias("kind"))


def with_previous(files: DataFrame) -> DataFrame:
    """Files with the file their feed sent just before (null for the first); ties by file_id."""
    return files.withColumn("previous_id", F.lag("file_id").over(Window.partitionBy("feed_name").orderBy("sent_at", "file_id")))


def file_schemas(rows: DataFrame) -> DataFrame:
    """Fused schema of each file: file_id, name, kinds (sorted non-null alternatives).

    Partial unions of at most six alternatives a name are all that is shuffled.
    """
    kind = kind_of(F.col("value"))
    each = exploded(documents(rows).select("file_id", "doc")).select("file_id", F.col("key").alias("name"), F.when(kind != "null", kind).alias("kind"))
    return each.groupBy("file_id", "name").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def compared(order: DataFrame, schemas: DataFrame) -> DataFrame:
    """Names that differ between a file and the one before: file_id, name, old_kinds, new_kinds, change."""
    new = order.join(schemas, "file_id").select("file_id", "name", F.col("kinds").alias("new_kinds"))
    old = order.join(schemas.withColumnRenamed("file_id", "previous_id"), "previous_id").select("file_id", "name", F.col("kinds").alias("old_kinds"))
    change = (
        F.when(F.col("old_kinds").isNull(), "added")
        .when(F.col("new_kinds").isNull(), "removed")
        .when((F.size("old_kinds") > 0) & (F.size("new_kinds") > 0) & (F.col("old_kinds") != F.col("new_kinds")), "retyped")
    )
    return new.join(old, ["file_id", "name"], "full").select("file_id", "name", "old_kinds", "new_kinds", change.alias("change")).where("change is not null")


def changes(files: DataFrame, rows: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """Changes of top-level names between each file and the one its feed sent just before.

    Result: file_id, column_name, change_kind (added, removed, renamed, retyped), old_name, old
    and new type alternatives. A name is there if any row has it, even with null; a name without
    non-null values in either file is not retyped. A rename joins a name that is gone to a new one
    if the records sent in both files have the same values under them (a name that a record lacks
    is null there) and at least one of these is not null; if several fit, the alphabetically first
    hold. A name may take part in one rename only. A file without rows has no names. Repeated
    rows count once. The first file of a feed has no changes. ``schemas`` are the files' fused
    schemas, if they are at hand.
    """
    order = checkpointed(with_previous(files).select("file_id", "previous_id").where("previous_id is not null"))
    differing = checkpointed(compared(order, checkpointed(file_schemas(rows)) if schemas is None else schemas))  # tables of files and names, not of rows
    renames = checkpointed(_renames(rows, order, differing))
    gone = renames.select("file_id", F.col("old_name").alias("name"), F.lit("removed").alias("change"), F.lit(True).alias("gone"))
    came = renames.select("file_id", F.col("new_name").alias("name"), F.lit("added").alias("change"), "old_name")
    return (
        differing.join(gone, ["file_id", "name", "change"], "left")
        .where("gone is null")
        .join(came, ["file_id", "name", "change"], "left")
        .select(
            "file_id",
            F.col("name").alias("column_name"),
            F.when(F.col("old_name").isNotNull(), "renamed").otherwise(F.col("change")).alias("change_kind"),
            "old_name",
            F.array_join("old_kinds", "|").alias("old_types"),
            F.array_join("new_kinds", "|").alias("new_types"),
        )
    )


def _renames(rows: DataFrame, order: DataFrame, differing: DataFrame) -> DataFrame:
    """Pairs file_id, old_name, new_name that hold the same values in the records of both files.

    Only files that lose and gain a name, and their predecessors, are read again, and of their rows
    only the record key and those names. Each name becomes a fingerprint of its values over the
    shared records; names with equal fingerprints are paired, so no two names are compared by record.
    """
    names = differing.where("change <> 'retyped'").groupBy("file_id").agg(
        F.collect_list(F.when(F.col("change") == "removed", F.col("name"))).alias("gone"), F.collect_list(F.when(F.col("change") == "added", F.col("name"))).alias("came")
    ).where("size(gone) > 0 and size(came) > 0").join(order, "file_id")
    sides = F.explode(F.array(F.struct(F.col("previous_id").alias("file_id"), F.lit(0).alias("side"), F.col("gone").alias("names")), F.struct("file_id", F.lit(1).alias("side"), F.col("came").alias("names"))))
    wanted = names.select(F.col("file_id").alias("pair"), sides.alias("s")).select("s.file_id", "pair", "s.side", "s.names")
    # A file is compared at most twice: with the one before it and with the one after it.
    tasks = wanted.groupBy("file_id").agg(F.collect_list(F.struct("pair", "side", "names")).alias("tasks"))
    key = F.to_json(F.variant_get("doc", f"$['{RECORD_KEY}']", "variant"))
    read = lookup_join(rows.select("file_id", "row_json"), tasks, ["file_id"], "inner")
    parsed = documents(read).select(F.explode("tasks").alias("t"), key.alias("record_key"), "doc").where("record_key is not null")
    # One row a record and name, and one without a name that says the record is there.
    values = exploded(parsed).select("t.pair", "t.side", "record_key", "key", F.col("t.names").alias("names"), F.to_json("value").alias("value"))
    held = values.where((F.col("key") == RECORD_KEY) | F.array_contains("names", F.col("key")))
    own = F.when(F.array_contains("names", F.col("key")), F.col("key"))
    named = held.select("pair", "side", "record_key", own.alias("name"), F.when(own.isNotNull() & (F.col("value") != "null"), F.col("value")).alias("value"))
    once = named.groupBy("pair", "record_key", "side", "name").agg(F.min("value").alias("value"))
    records = once.groupBy("pair", "record_key").agg(
        F.count_distinct("side").alias("n_sides"), F.collect_list(F.when(F.col("value").isNotNull(), F.struct("side", "name", F.xxhash64("record_key", "value").alias("h1"), F.xxhash64(F.lit("second"), "value", "record_key").alias("h2")))).alias("values")
    )
    prints = (
        records.where("n_sides = 2")
        .select("pair", F.explode("values").alias("v"))
        .groupBy("pair", "v.side", "v.name")
        .agg(F.bit_xor("v.h1").alias("p1"), F.bit_xor("v.h2").alias("p2"), F.count("*").alias("n"))
    )
    place = Window.partitionBy("pair", "side", "p1", "p2", "n").orderBy("name")
    ranked = prints.withColumn("place", F.row_number().over(place)).where("place = 1")
    old = ranked.where("side = 0").select("pair", "p1", "p2", "n", F.col("name").alias("old_name"))
    new = ranked.where("side = 1").select("pair", "p1", "p2", "n", F.col("name").alias("new_name"))
    return old.join(new, ["pair", "p1", "p2", "n"]).select(F.col("pair").alias("file_id"), "old_name", "new_name")


def canonical_name(name: Column) -> Column:
    """Letters and digits of a name, lower case."""
    return F.lower(F.regexp_replace(name, r"[^\p{L}\p{N}]", ""))


def frequency_value(value: Column, kind: Column) -> Column:
    """One number for each branch of the frequency union.

    Text is a fraction a/b or a//b, a percentage or a decimal; an array is [a, b]; an object holds
    num and den; a number is the frequency itself. What none of these fits is null.
    """
    text = F.trim(F.when(kind == "string", F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")))
    parts = F.split(text, "/+")
    ratio = F.try_divide(F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double"))
    percent = F.regexp_replace(text, "%$", "").try_cast("double") / 100
    pair = F.try_divide(F.get_json_object(value, "$[0]").try_cast("double"), F.get_json_object(value, "$[1]").try_cast("double"))
    members = F.try_divide(F.get_json_object(value, "$.num").try_cast("double"), F.get_json_object(value, "$.den").try_cast("double"))
    return (
        F.when(kind == "number", value.try_cast("double"))
        .when(kind == "array", pair)
        .when(kind == "object", members)
        .when(text.contains("/"), ratio)
        .when(text.endswith("%"), percent)
        .otherwise(text.try_cast("double"))
    )


def comment_value(value: Column) -> Column:
    """One text for each branch of the comment union: the text, and what else it holds in brackets.

    Text stays as it is; an array gives its first element as the text, an object its member
    ``text`` (and its other members in order of their names). An array or object without a text, and
    any other value, is its JSON. ``value`` is a variant.
    """
    kind = kind_of(value)

    def bracketed(first: Column, rest: Column) -> Column:
        return F.when(F.size(rest) == 0, first).otherwise(F.concat(first, F.lit(" ("), F.array_join(rest, ", "), F.lit(")")))

    items = F.try_variant_get(value, "$", "array<string>")
    held = F.try_variant_get(value, "$", "map<string,string>")
    others = F.transform(F.array_sort(F.map_entries(F.map_filter(held, lambda k, _: k != "text"))), lambda e: e["value"])
    return F.coalesce(
        F.when(kind == "string", F.try_variant_get(value, "$", "string"))
        .when(kind == "array", bracketed(F.get(items, F.lit(0)), F.slice(items, 2, 2**31 - 1)))
        .when(kind == "object", bracketed(F.try_element_at(held, F.lit("text")), others)),
        F.to_json(value),
    )


def linked_names(found: DataFrame, names: DataFrame, target: str) -> list[str]:
    """Names that mean the field ``target``: those written like it, and all that renames lead to or from.

    ``found`` are the changes of all feeds. Both tables are of names, not of rows.
    """
    pairs = found.where("change_kind = 'renamed'").select("old_name", F.col("column_name").alias("new_name")).distinct().limit(MAX_LINKS + 1).collect()
    if len(pairs) > MAX_LINKS:
        raise ValueError(f"more than {MAX_LINKS} different renames")
    alike = names.where(canonical_name(F.col("name")) == target).select("name").distinct().collect()
    known, near = {r[0] for r in alike}, {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    open_ends = list(known)
    while open_ends:
        for other in near.get(open_ends.pop(), set()) - known:
            known.add(other)
            open_ends.append(other)
    return sorted(known)


def unified(files: DataFrame, rows: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """All rows of all feeds as one table.

    The fixed fields keep their names; meta_subset_frequency is a number whatever its name and
    form, next to the branch it came from; comment is text (``comment_value``). Which names mean these two is learned
    from the renames between files (``found``, the changes), not listed. All other members stay in
    ``others``, one JSON object with its names in order. Rows that are no JSON object come out with
    nulls. A row stays one row in its task: nothing is shuffled but the small table of files.
    """
    schemas = checkpointed(file_schemas(rows))
    found = checkpointed(changes(files, rows, schemas)) if found is None else found
    names = schemas.select("name").distinct()
    fixed = {"record_key": RECORD_KEY, "cdr3_beta": "cdr3.beta", "species": "species", "antigen_epitope": "antigen.epitope", "antigen_species": "antigen.species", "reference_id": "reference.id"}
    frequency, comment = linked_names(found, names, FREQUENCY), linked_names(found, names, COMMENT)
    rows.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    parsed = rows.select("row_id", "file_id", "line_no", F.try_variant_get(F.try_parse_json("row_json"), "$", "map<string,variant>").alias("members"))

    def first_of(names: Sequence[str]) -> Column:
        """The alphabetically first of ``names`` that the row states with a value."""
        stated = F.filter(F.map_entries("members"), lambda e: e["key"].isin(list(names)) & ~F.is_variant_null(e["value"]))
        return F.array_min(F.transform(stated, lambda e: e["key"]))

    def text(name: Column) -> Column:
        value = F.try_element_at("members", name)
        return F.coalesce(F.try_variant_get(value, "$", "string"), F.when(~F.is_variant_null(value), F.to_json(value)))  # scalars as text

    def as_json(entry: Column) -> Column:
        name = F.to_json(F.array(entry["key"]))
        return F.struct(entry["key"], F.concat(F.substring(name, F.lit(2), F.length(name) - 2), F.lit(":"), F.to_json(entry["value"])).alias("text"))

    other = F.filter(F.map_entries("members"), lambda e: ~e["key"].isin([*fixed.values(), *frequency, *comment]))
    others = F.array_join(F.transform(F.array_sort(F.transform(other, as_json)), lambda x: x["text"]), ",")
    named = parsed.select("*", first_of(frequency).alias("__f"), first_of(comment).alias("__c"))
    branches = named.select("*", F.try_element_at("members", F.col("__f")).alias("__branch"), F.try_element_at("members", F.col("__c")).alias("__text"))
    chosen = branches.select("*", kind_of(F.col("__branch")).alias("__kind"), F.to_json("__branch").alias("__value"))
    known = F.col("__f").isNotNull()
    table = chosen.select(
        "row_id", "file_id", "line_no", *[text(F.lit(n)).alias(c) for c, n in fixed.items()],
        F.when(known, frequency_value(F.col("__value"), F.col("__kind"))).alias("meta_subset_frequency"),
        F.when(known, F.col("__kind")).alias("frequency_branch"),
        F.when(F.col("__c").isNotNull(), comment_value(F.col("__text"))).alias("comment"),
        F.when(F.col("members").isNotNull(), F.concat(F.lit("{"), others, F.lit("}"))).alias("others"),
    )
    return lookup_join(table, files.select("file_id", "feed_name", "sent_at"), ["file_id"])
