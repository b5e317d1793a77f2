"""Landed page bodies to tables.

A body is one response as it was landed, kept as text: DataFrame(source, page, body).
Two shapes exist. An *indicator page* is a two-element array ``[meta, records]``; a
*feature page* is an object ``{features: [{attributes}], exceededTransferLimit}``.
A body holds at most one page of records, so parsing is a narrow, per-row job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from harborline.functions.columns import nan_to_null
from harborline.operators.observed import Observed
from harborline.session import stage

STRICT = {"mode": "FAILFAST"}
BLOCK = 10_000
NO_NUMBER = "no page number"


def read_bodies(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """One body per file, or (``packed``) many bodies per Parquet file.

    Packed is the layout for volume: millions of small files would be slow to list.
    """
    if packed:
        return spark.read.schema("source string, page int, body string").parquet(path)
    files = spark.read.text(path, wholetext=True)
    name = F.col("_metadata.file_path")
    number = F.regexp_extract(name, r"(\d+)[^/\d]*$", 1)
    return files.select(
        name.alias("source"), number.try_cast("int").alias("page"), F.col("value").alias("body")
    )


# ---- one parse -------------------------------------------------------------------


def indicator_pages(bodies: DataFrame) -> DataFrame:
    """(source, page, body, problem, announced, records): each body taken apart, its records still text.

    ``announced`` is the page count the metadata element names. Everything else here reads this frame;
    staged (`stage_pages`), a body is parsed once however many readers follow.
    """
    parts = bodies.select("source", "body", F.from_json("body", "array<string>").alias("parts")).withColumn(
        "problem",
        F.when(F.col("parts").isNull() | (F.size("parts") < 2), F.lit("no records element")),
    )
    meta = F.from_json(F.get("parts", F.lit(0)), "page int, pages int")
    return parts.withColumn("meta", F.when(F.col("problem").isNull(), meta)).select(
        "source", F.col("meta.page").alias("page"), "body", "problem", F.col("meta.pages").alias("announced"),
        F.from_json(F.get("parts", F.lit(1)), "array<string>").alias("records"),
    )


def feature_pages(bodies: DataFrame) -> DataFrame:
    """(source, page, body, problem, more, records): as `indicator_pages`; ``more`` is the transfer-limit flag."""
    keys = F.json_object_keys("body")
    shape = "features array<struct<attributes: string>>, exceededTransferLimit boolean"
    problem = F.when(keys.isNull(), F.lit("not an object")).when(
        F.array_contains(keys, "error"), F.lit("error body")
    )
    parsed = bodies.select("source", "page", "body", problem.alias("problem")).withColumn(
        "parsed", F.when(F.col("problem").isNull(), F.from_json("body", shape))
    )
    unread = F.col("parsed.features").isNull() & F.get_json_object("body", "$.features").isNotNull()
    return parsed.select(
        "source", "page", "body",
        F.when(F.col("problem").isNull() & unread, F.lit("features are no list")).otherwise(F.col("problem")).alias("problem"),
        F.coalesce("parsed.exceededTransferLimit", F.lit(False)).alias("more"),
        F.col("parsed.features.attributes").alias("records"),
    )


PAGES = {"indicator": indicator_pages, "features": feature_pages}


def stage_pages(bodies: DataFrame, shape: str, name: str = "pages") -> tuple[DataFrame, dict[str, int]]:
    """The pages of a landing as a written table, and what the write counted: bodies, unreadable ones, records."""
    pages = PAGES[shape](bodies).drop("body")
    records = F.when(F.col("problem").isNull(), F.greatest(F.size("records"), F.lit(0)))
    counted = Observed(
        bodies=F.count("*"), unreadable=F.count("problem"), records=F.coalesce(F.sum(records.cast("bigint")), F.lit(0))
    )
    return stage(counted.on(pages), name), counted.values()


def _or_fail(value: Column) -> Column:
    """Value of a readable body; an unreadable one stops the job and names its source."""
    message = F.concat(F.col("problem"), F.lit(" in "), F.coalesce("source", F.lit("unnamed body")))
    return F.when(F.col("problem").isNotNull(), F.raise_error(message)).otherwise(value)


def page_records(pages: DataFrame, shape: str, positions: bool = False) -> DataFrame:
    """All records of all pages, one row each under the stated columns, nested fields kept as structs.

    A value of another type stops the job; ``positions`` adds (page, position).
    """
    texts = pages.select("page", F.posexplode(_or_fail(F.col("records"))).alias("position", "text"))
    kept = ["page", "position"] if positions else []
    rows = texts.select(*kept, F.from_json("text", shape, STRICT).alias("record"))
    return nan_to_null(rows.select(*kept, "record.*"))


def page_attributes(pages: DataFrame, shape: str, rest: str = "unlisted") -> DataFrame:
    """The rows of `page_records` with the fields the shape does not name, in one VARIANT column (NULL if there are none)."""
    listed = [f.name for f in T._parse_datatype_string(shape)]
    texts = pages.select(F.explode(_or_fail(F.col("records"))).alias("text"))
    every = F.try_variant_get(F.parse_json("text"), "$", "map<string, variant>")
    others = F.map_filter(every, lambda name, _: ~name.isin(listed))
    rows = texts.select(
        F.from_json("text", shape, STRICT).alias("record"), F.when(F.size(others) > 0, F.to_variant_object(others)).alias(rest)
    )
    return nan_to_null(rows.select("record.*", rest))


def field_inventory(pages: DataFrame, parents=()) -> DataFrame:
    """(field, data_type, records): every field that records carry, listed or not, and how many have it in which type.

    Types are those of the values as they stand in the text: whole numbers are BIGINT, others DECIMAL or DOUBLE, an
    explicit null is VOID. The fields inside ``parents`` are named with a dot and have no type. One pass; counts are
    combined before the shuffle, so a row for each field and type leaves a task.
    """
    records = pages.where("problem IS NULL").select(F.explode("records").alias("text"))
    parsed = records.select(F.try_parse_json("text").alias("record"))
    fields = parsed.lateralJoin(pages.sparkSession.tvf.variant_explode(F.col("record").outer())).where("key IS NOT NULL")
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    names = F.array(F.struct(F.col("key").alias("field"), kind.alias("data_type")))
    if parents:
        inner = F.when(F.col("key").isin(list(parents)), F.json_object_keys(F.to_json("value")))
        dotted = F.transform(
            F.coalesce(inner, F.array().cast("array<string>")),
            lambda k: F.struct(F.concat_ws(".", "key", k).alias("field"), F.lit(None).cast("string").alias("data_type")),
        )
        names = F.concat(names, dotted)
    return fields.select(F.inline(names)).groupBy("field", "data_type").agg(F.count("*").alias("records"))


def absent_fields(inventory: DataFrame, required) -> DataFrame:
    """Required fields (dotted names are nested) that no record of an inventory carries."""
    wanted = inventory.sparkSession.createDataFrame([(f,) for f in required], "field string")
    return wanted.join(inventory, "field", "left_anti")


def unlisted_fields(inventory: DataFrame, listed) -> DataFrame:
    """The part of an inventory outside the listed fields: what a fixed list of columns would lose."""
    names = {name.partition(".")[0] for name in listed}
    return inventory.where(~F.col("field").isin(sorted(names)) & ~F.contains("field", F.lit(".")))


def parents_of(fields) -> list[str]:
    """The fields that hold the nested ones among dotted names."""
    return sorted({name.partition(".")[0] for name in fields if "." in name})


# ---- readers of bodies -------------------------------------------------------------


def read_indicator_pages(bodies: DataFrame, record: str) -> DataFrame:
    """All records of all indicator pages, one row each."""
    return page_records(indicator_pages(bodies), record)


def read_feature_pages(bodies: DataFrame, attributes: str, positions: bool = False) -> DataFrame:
    """Attributes of all features, one row each; ``positions`` adds (page, position)."""
    return page_records(feature_pages(bodies), attributes, positions)


def readable_features(bodies: DataFrame) -> DataFrame:
    """The bodies that are feature pages; the others are in ``quarantine_features``."""
    return feature_pages(bodies).where("problem IS NULL").select("source", "page", "body")


def quarantine_indicator(bodies: DataFrame) -> DataFrame:
    """Bodies that are not a page, with the reason."""
    return indicator_pages(bodies).where("problem IS NOT NULL").select("source", "problem", "body")


def quarantine_features(bodies: DataFrame) -> DataFrame:
    return feature_pages(bodies).where("problem IS NOT NULL").select("source", "problem", "body")


# ---- are all pages there -----------------------------------------------------------


def page_gaps(pages: DataFrame, step: int = 1, last: DataFrame | None = None) -> DataFrame:
    """Page numbers that are absent, as ranges: (first_page, last_page, pages), both ends included.

    Counted pages are 1, 2, 3, ...; pages numbered by offset are 0, step, 2 * step, ... A stray number far out is one
    range, not a row for each page before it. ``last`` is a one-row frame with the last page there should be; without,
    the largest one found. Gaps are looked for within blocks of numbers and, from each block's ends, between them, so the
    one window over everything has a row for each block that has pages.
    """
    first = 1 if step == 1 else 0
    found = pages.select(F.col("page").cast("bigint").alias("page")).where(f"page >= {first}")
    # A page before the first one and one after the last make all gaps alike.
    ends = found.sparkSession.range(1).select(F.lit(first - step).cast("bigint").alias("page"))
    if last is not None:
        ends = ends.union(last.select(F.col("last").cast("bigint") + step).where("last IS NOT NULL"))
    block = F.floor((F.col("page") - first) / (step * BLOCK))
    numbers = found.union(ends).distinct().withColumn("block", block)
    ahead = F.lead("page").over(Window.partitionBy("block").orderBy("page"))
    inside = numbers.select("page", ahead.alias("next"))
    blocks = numbers.groupBy("block").agg(F.min("page").alias("low"), F.max("page").alias("page"))
    between = blocks.select("page", F.lead("low").over(Window.orderBy("block")).alias("next"))
    gaps = inside.union(between).where(F.col("next") - F.col("page") > step)
    return gaps.select(
        (F.col("page") + step).alias("first_page"), (F.col("next") - step).alias("last_page"),
        (F.floor((F.col("next") - F.col("page") - 1) / step)).alias("pages"),
    ).where("pages > 0")


def _found_pages(pages: DataFrame, *more: Column) -> DataFrame:
    count = F.greatest(F.coalesce(F.size("records"), F.lit(0)), F.lit(0))
    return stage(
        pages.where("problem IS NULL").groupBy("page").agg(
            F.count("*").alias("bodies"), F.sum(count).cast("bigint").alias("records"), *more
        ), "audit",
    )


def _indicator_issues(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per page its issue, and the last page there should be: the page count of the metadata element."""
    found = _found_pages(pages, F.max("announced").alias("pages"))
    issue = F.when(F.col("page").isNull(), NO_NUMBER).when(F.col("bodies") > 1, "repeated").when(
        (F.col("records") == 0) & (F.col("page") < F.col("pages")), "empty before the last page"
    )
    last = found.agg(F.max("pages").cast("bigint").alias("last"))
    return found.select("page", "bodies", "records", issue.alias("issue")), last


def _feature_issues(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per page its issue, judged by the transfer-limit flag, and the last page found."""
    found = _found_pages(pages, F.bool_or("more").alias("more"))
    last = found.agg(F.max("page").cast("bigint").alias("last"))
    final = F.col("page") == last.select("last").scalar()
    issue = (
        F.when(F.col("page").isNull(), NO_NUMBER)
        .when(F.col("bodies") > 1, "repeated")
        .when(final & F.col("more"), "cut off: more was announced")
        .when(~final & (F.col("records") == 0), "empty before the last page")
        .when(~final & ~F.col("more"), "end announced too early")
    )
    return found.select("page", "bodies", "records", issue.alias("issue")), last


def page_problems(pages: DataFrame, shape: str, step: int = 1) -> DataFrame:
    """(issue, pages): how many pages have which issue; absent ones are counted from their ranges, never listed."""
    found, last = _indicator_issues(pages) if shape == "indicator" else _feature_issues(pages)
    issues = found.where("issue IS NOT NULL").groupBy("issue").agg(F.count("*").alias("pages"))
    absent = page_gaps(found, step, last if shape == "indicator" else None)
    missing = absent.agg(F.lit("missing").alias("issue"), F.sum("pages").alias("pages")).where("pages IS NOT NULL")
    return issues.unionByName(missing)


def _page_numbers(last: DataFrame, step: int) -> DataFrame:
    """The page numbers up to ``last`` from a one-row frame, in blocks, so that no array or task grows with it.

    Counted pages are 1, 2, 3, ...; pages numbered by offset are 0, step, 2 * step, ...
    """
    last = last.select(F.col("last") if step == 1 else F.expr(f"last div {step} + 1").alias("last"))
    blocks = last.where("last >= 1").select(
        "last", F.explode(F.sequence(F.lit(0), (F.col("last") - 1).cast("bigint"), F.lit(BLOCK))).alias("low")
    )
    numbers = blocks.repartition("low").select(
        F.explode(F.sequence(F.col("low") + 1, F.least(F.col("low") + BLOCK, "last"))).alias("page")
    )
    number = F.col("page") if step == 1 else (F.col("page") - 1) * step
    return numbers.select(number.cast("int").alias("page"))


def _with_missing(found: DataFrame, last: DataFrame, step: int = 1) -> DataFrame:
    absent = _page_numbers(last, step).join(found, "page", "left_anti")
    return found.unionByName(
        absent.select("page", F.lit(0).cast("bigint").alias("bodies"), F.lit(0).cast("bigint").alias("records"),
                      F.lit("missing").alias("issue"))
    )


def audit_indicator_pages(bodies: DataFrame) -> DataFrame:
    """Per page: bodies, records and an issue (missing, repeated, empty before the end).

    The page count comes from the metadata element. Nothing is cut off at a page
    limit; what is not there is reported.
    """
    return _with_missing(*_indicator_issues(indicator_pages(bodies)))


def audit_feature_pages(bodies: DataFrame, step: int = 1) -> DataFrame:
    """Per page number: bodies, records and an issue, judged by the transfer-limit flag.

    Every page but the last must carry records and announce more; the last must not. Pages
    are counted from 1; where they are numbered by offset, ``step`` is the page size. Absent pages are
    listed one by one; `page_gaps` and `page_problems` know them as ranges.
    """
    return _with_missing(*_feature_issues(feature_pages(bodies)), step)


def missing_fields(bodies: DataFrame, required, shape: str) -> DataFrame:
    """Required fields that no record carries at all (dotted names are nested); none where there is no record."""
    inventory = field_inventory(PAGES[shape](bodies), parents_of(required))
    found = absent_fields(inventory, required)
    return found.where(inventory.limit(1).agg(F.count("*")).scalar() > 0)
