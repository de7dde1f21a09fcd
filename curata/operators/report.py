"""Statistics of the report over the collapsed and full tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curata.operators.fixer import in_parts
from curata.session import checkpointed, lookup_join


def first_of(c: str, mark: str = ",") -> Column:
    """Text before the first mark."""
    return F.split_part(F.col(c), F.lit(mark), F.lit(1))


def counts_by(slim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records, paired records, distinct epitopes and distinct first references by key."""
    return slim.groupBy(*keys).agg(
        F.count("*").alias("records"),
        F.sum(F.when(F.col("complex_id") == "0", 0).otherwise(1)).alias("paired_records"),
        F.count_distinct("antigen_epitope").alias("epitopes"),
        F.count_distinct(first_of("reference_id")).alias("publications"),
    )


def mhc_label() -> Column:
    """First MHC chain for class I, both chains (the second without its prefix) for class II; alleles cut at the first colon or comma."""
    a, b = F.get(F.split("mhc_a", "[,:]"), F.lit(0)), F.get(F.split("mhc_b", "[,:]"), F.lit(0))
    return F.when(F.col("mhc_class") == "MHCI", a).otherwise(F.concat(a, F.lit("/"), F.substring(b, 7, 9)))


def antigen_chains(slim: DataFrame, prefix: str, species: str = "HomoSapiens") -> DataFrame:
    """Records by antigen gene, MHC, epitope and chain of antigens whose species starts with ``prefix``.

    publications counts the distinct first references of the epitope over both chains.
    """
    own = slim.where((F.col("species") == species) & F.col("antigen_species").startswith(prefix)).withColumn("mhc", mhc_label()).withColumn("ref", first_of("reference_id"))
    keys = ["antigen_gene", "mhc", "antigen_epitope"]
    publications = own.groupBy(*keys).agg(F.count_distinct("ref").alias("publications"))
    return own.groupBy(*keys, "gene").agg(F.count("*").alias("records")).join(publications, keys)


def by_chain(counts: DataFrame, least: int = 10) -> DataFrame:
    """Chains side by side, at least ``least`` records together, most first; ``*`` in MHC names as a dot."""
    wide = counts.groupBy("antigen_gene", "mhc", "antigen_epitope", "publications").pivot("gene", ["TRA", "TRB"]).agg(F.sum("records")).na.fill(0, ["TRA", "TRB"])
    return wide.withColumn("mhc", F.replace("mhc", F.lit("*"), F.lit("."))).where(F.col("TRA") + F.col("TRB") >= least).orderBy(F.desc(F.col("TRA") + F.col("TRB")), "antigen_gene", "mhc", "antigen_epitope")


def score_distribution(slim: DataFrame, species: str = "HomoSapiens") -> DataFrame:
    return slim.where(F.col("species") == species).groupBy("mhc_class", "gene", "confidence_score").agg(F.count("*").alias("total"))


def spectratype(slim: DataFrame, keys: Sequence[str] = ("gene", "mhc_class"), low: int = 5, high: int = 25) -> DataFrame:
    """CDR3 length histogram by facet, within limits."""
    length = F.length("cdr3").alias("cdr3_length")
    return slim.select(*keys, length).where(F.col("cdr3_length").between(low, high)).groupBy(*keys, "cdr3_length").agg(F.count("*").alias("n"))


def density(histogram: DataFrame, keys: Sequence[str] = ("gene", "mhc_class"), value: str = "cdr3_length", adjust: float = 3.0, grid: int = 41, low: int = 5, high: int = 25) -> DataFrame:
    """Gaussian kernel density (times the count) of a histogram on a grid; one bandwidth per facet.

    The bandwidth is Silverman's rule (with the standard deviation) times ``adjust``.
    """
    n, x = F.sum("n"), F.col(value)
    mean = F.sum(x * F.col("n")) / n
    moments = histogram.groupBy(*keys).agg(n.alias("total"), mean.alias("mean"), (F.sum(x * x * F.col("n")) / n).alias("square"))
    spread = moments.withColumn("sd", F.sqrt(F.greatest(F.col("square") - F.col("mean") * F.col("mean"), F.lit(1e-12)))).withColumn(
        "bw", 0.9 * F.col("sd") * F.pow(F.col("total").cast("double"), F.lit(-0.2)) * adjust
    )
    points = spread.withColumn("x", F.explode(F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), lambda i: low + i * ((high - low) / (grid - 1)))))
    joined = histogram.join(points.select(*keys, "x", "bw"), list(keys))  # 41 points a facet
    kernel = F.exp(-0.5 * F.pow((F.col("x") - x) / F.col("bw"), 2)) / (F.col("bw") * F.sqrt(F.lit(2 * 3.141592653589793)))
    return joined.groupBy(*keys, "x").agg(F.sum(kernel * F.col("n")).alias("density"))


def exploded(rows: DataFrame, columns: Sequence[str], mark: str = ",") -> DataFrame:
    """One row per piece of each column's list, column after column."""
    result = rows
    for c in columns:
        result = result.withColumn(c, F.explode(F.split(c, mark)))
    return result


def usage(slim: DataFrame, id_column: str, least: int = 10, species: str = "HomoSapiens") -> DataFrame:
    """Records by chain, MHC and V gene (lists taken apart, alleles cut), for MHCs and V genes of
    at least ``least`` records."""
    each = exploded(slim.where(F.col("species") == species).select(id_column, "gene", "mhc_class", "mhc_a", "mhc_b", "v_segm"), ["mhc_a", "mhc_b", "v_segm"])
    named = each.select(id_column, "gene", "mhc_class", first_of("mhc_a", ":").alias("mhc_a"), first_of("mhc_b", ":").alias("mhc_b"), first_of("v_segm", "*").alias("v_gene"))
    counts = named.groupBy("gene", "mhc_class", "mhc_a", "mhc_b", "v_gene").agg(F.count_distinct(id_column).alias("records"))
    by_mhc, by_v = Window.partitionBy("mhc_class", "mhc_a", "mhc_b"), Window.partitionBy("gene", "v_gene")
    return counts.withColumn("records_mhc", F.sum("records").over(by_mhc)).withColumn("records_v", F.sum("records").over(by_v)).where(
        (F.col("records_mhc") >= least) & (F.col("records_v") >= least)
    )


def observed_to_expected(counts: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Ratio of each cell of a table to what its row and column sums let expect."""
    cells = counts.groupBy(row, column).agg(F.sum(value).alias("n"))
    rows = cells.groupBy(row).agg(F.sum("n").alias("row_n"))
    columns = cells.groupBy(column).agg(F.sum("n").alias("column_n"))
    total = cells.select(F.sum("n").alias("n")).scalar()
    ratio = F.col("n") * total / (F.col("row_n") * F.col("column_n"))
    return cells.join(rows, row).join(columns, column).select(row, column, "n", ratio.alias("ratio"))


def mhc_detail(slim: DataFrame, id_column: str, species: str = "HomoSapiens") -> DataFrame:
    """Records, epitopes and first references by pair of MHC chains."""
    each = exploded(slim.where(F.col("species") == species), ["mhc_a", "mhc_b"])
    return each.groupBy(first_of("mhc_a", ":").alias("mhc_a"), first_of("mhc_b", ":").alias("mhc_b")).agg(
        F.count_distinct(id_column).alias("records"), F.count_distinct("antigen_epitope").alias("antigens"), F.count_distinct(first_of("reference_id")).alias("publications")
    )


def chain_keys() -> list[Column]:
    """Receptor key, MHC key and which chains a record has."""
    def text(cs: Sequence[str]) -> Column:
        return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in cs])

    chains = F.when(F.col("cdr3_alpha").isNotNull(), F.when(F.col("cdr3_beta").isNotNull(), "paired").otherwise("TRA")).otherwise("TRB")
    return [text(["v_alpha", "j_alpha", "cdr3_alpha", "v_beta", "j_beta", "cdr3_beta"]).alias("tcr_key"), text(["mhc_a", "mhc_b"]).alias("mhc_key"), chains.alias("chains")]


def cumulative_by_year(rows: DataFrame, dates: DataFrame, measures: Sequence[str] = ("tcr_key", "antigen_epitope", "reference_id", "mhc_key")) -> DataFrame:
    """Distinct values seen up to each year, by chains, for every pair of a year and kind of chains.

    Instead of a join of all years with all earlier ones, each value counts in the year it is first
    seen, and the counts are summed up over the years. ``dates`` has reference_id and pub_date.
    """
    years = checkpointed(dates.where("pub_date is not null").groupBy("reference_id").agg(F.min("pub_date").alias("pub_date")))
    return cumulative(lookup_join(rows.select("reference_id", "chains", *[m for m in measures if m != "reference_id"]), years, ["reference_id"], "inner"), years, measures)


def cumulative(dated: DataFrame, years: DataFrame, measures: Sequence[str] = ("tcr_key", "antigen_epitope", "reference_id", "mhc_key")) -> DataFrame:
    """As ``cumulative_by_year``, of rows that have their pub_date already; ``years`` has every pub_date."""
    # One pass for all measures: each value in the year it is first seen, then new values by year.
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("string").alias("value")) for m in measures]))
    first = dated.select("chains", "pub_date", each.alias("m")).where("m.value is not null").groupBy("chains", "m.measure", "m.value").agg(F.min("pub_date").alias("pub_date"))
    new = checkpointed(first.groupBy("chains", "pub_date").agg(*[F.count(F.when(F.col("measure") == m, 1)).alias(f"{m}_count") for m in measures]))
    kinds = new.select(F.array_sort(F.collect_set("chains")).alias("kinds")).first()[0]  # three at most
    grid = years.select("pub_date").distinct().select("pub_date", F.explode(F.lit(kinds) if kinds else F.array().cast("array<string>")).alias("chains"))
    up_to = Window.partitionBy("chains").orderBy("pub_date").rowsBetween(Window.unboundedPreceding, 0)
    result = grid.join(new, ["chains", "pub_date"], "left")
    return result.select("pub_date", "chains", *[F.coalesce(F.sum(f"{m}_count").over(up_to), F.lit(0)).alias(f"{m}_count") for m in measures])


def totals_by_reference(slim: DataFrame, antigen_species: str) -> DataFrame:
    """Records of an antigen species by reference and epitope, with the reference's total."""
    own = exploded(slim.where(F.col("antigen_species") == antigen_species).select("antigen_epitope", "reference_id"), ["reference_id"])
    counts = own.groupBy("reference_id", "antigen_epitope").agg(F.count("*").alias("n"))
    totals = counts.groupBy("reference_id").agg(F.sum("n").alias("total"))
    return counts.join(totals, "reference_id")


def placed(counts: DataFrame, places: DataFrame) -> DataFrame:
    """Counts with the distinct places of their references; references without a place are left out."""
    return lookup_join(counts, places.distinct(), ["reference_id"], "inner")


def pivoted(counts: DataFrame, keys: Sequence[str], column: str, value: str, most: int = 2000) -> DataFrame:
    """A pivot over every value that the column has, in order, zero where there is none.

    The values are collected; more than ``most`` are too many columns and raise. Null has the column ``null``.
    """
    found = [r[0] for r in counts.select(column).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    values = sorted(found, key=lambda v: (v is None, v or ""))
    sums = [F.sum(F.when(F.col(column).eqNullSafe(F.lit(v)), F.col(value)).otherwise(0)).alias("null" if v is None else v) for v in values]
    return counts.groupBy(*keys).agg(*sums) if sums else counts.select(*keys)


def epitope_ranks(slim: DataFrame, species: str = "HomoSapiens") -> DataFrame:
    """Distinct CDR3 by chain and epitope with their rank, largest first; ties share the mean rank."""
    keys = ["gene", "mhc_class", "antigen_species", "antigen_gene", "antigen_epitope"]
    counts = slim.where(F.col("species") == species).groupBy(*keys).agg(F.count_distinct("cdr3").alias("cdr3_count"))
    sizes = counts.groupBy("cdr3_count").agg(F.count("*").alias("ties"))  # one row per distinct size
    above = Window.orderBy(F.desc("cdr3_count")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = sizes.withColumn("rank", F.coalesce(F.sum("ties").over(above), F.lit(0)) + (F.col("ties") + 1) / 2)
    return lookup_join(counts, ranks.drop("ties"), ["cdr3_count"], "inner")


def loglog_fit(ranks: DataFrame, keys: Sequence[str] = ("gene", "mhc_class")) -> DataFrame:
    """Least squares line of log10 rank over log10 count by facet."""
    y, x = F.log10(F.col("rank").cast("double")), F.log10(F.col("cdr3_count").cast("double"))
    return ranks.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def ambiguous_names(rows: DataFrame, species: str = "HomoSapiens") -> DataFrame:
    """Distinct antigen triples; those whose epitope has several names are marked ``*``."""
    triples = rows.where(F.col("species") == species).select("antigen_species", "antigen_gene", "antigen_epitope").distinct()
    many = triples.groupBy("antigen_epitope").agg(F.count("*").alias("__n"))
    return triples.join(many, "antigen_epitope").withColumn("ambiguous", F.when(F.col("__n") > 1, "*").otherwise("")).drop("__n")


def reordered(rows: DataFrame, category: str, value: str) -> DataFrame:
    """Each category with the median of a value and its place in that order (ties by name)."""
    medians = rows.groupBy(category).agg(F.percentile(value, 0.5).alias("median"))
    return medians.withColumn("place", F.row_number().over(Window.orderBy("median", category)))  # one row per category


def with_last_before(rows: DataFrame, document: str, order: str, value: Column, name: str) -> DataFrame:
    """Rows in parts (``in_parts``) with the last non-null ``value`` of the lines before them in their document.

    Within a part this is a window; across parts only each part's last value per document is carried.
    """
    valued = rows.withColumn("__value", value)
    keys = ["__part", document]
    last = valued.where("__value is not null").groupBy(*keys).agg(F.max_by("__value", order).alias("__last"))
    parts = valued.select(*keys).distinct().join(last, keys, "left")
    earlier = Window.partitionBy(document).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.withColumn("__carried", F.last("__last", ignorenulls=True).over(earlier)).where("__carried is not null").select(*keys, "__carried")
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = valued.withColumn("__local", F.last("__value", ignorenulls=True).over(inside))
    return lookup_join(local, carried, keys).withColumn(name, F.coalesce("__local", "__carried")).drop("__value", "__local", "__carried")


def html_embed(lines: DataFrame, document: str, order: str, text: str, start: str = "!summary_embed_start!", end: str = "!summary_embed_end!") -> DataFrame:
    """Lines of HTML documents between the marks, without code blocks and div lines, tables restyled.

    Two states run along a document. Behind a start mark (not on its line) lines are in, from an end
    mark on they are out. While in, a line that opens a code block is in code, itself included,
    until behind a line that closes it; one that does both is code by itself. Either mark ends a
    code block. Each state is set by the last line before that sets it, so no line depends on a
    chain of others, and a document of any length is spread over many tasks. Null lines are left
    out; of lines with the same place the order is open.
    """
    c = F.col(text)
    starts, ends = c.contains(start), c.contains(end)
    opens, shuts = c.contains('<pre class="r"><code>'), c.contains("</code></pre>")
    # What a line leaves behind it. A line with both marks is out and then in again.
    mark = F.when(starts, True).when(ends, False)
    placed = checkpointed(in_parts(lines.where(c.isNotNull()).select(document, order, text), [document, order]))
    marked = with_last_before(placed, document, order, mark, "__before")
    inside = F.coalesce("__before", F.lit(False)) & ~ends
    code = F.when(starts | ends | shuts, False).when(inside & opens, True)
    coded = with_last_before(marked.withColumn("__in", inside), document, order, code, "__code")
    kept = coded.where(F.col("__in") & ~F.coalesce("__code", F.lit(False)) & ~opens & ~c.startswith("<div") & ~c.startswith("</div"))
    output = F.when(c.startswith("<pre><code>##"), F.replace(F.replace(c, F.lit("#"), F.lit("")), F.lit("&quot;"), F.lit(""))).otherwise(c)
    styled = F.replace(output, F.lit("<table>"), F.lit('<table class="ui unstackable single line celled stripped compact small table">'))
    return kept.select(document, order, F.replace(styled, F.lit('width="1152"'), F.lit('width="672"')).alias(text))
