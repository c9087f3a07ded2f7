"""The driver's flat test tables as a nested feed: one record per order, its lines as child arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runstar.sources.workspace import exchange_tasks

AGENCY = "testdata"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nest(df: DataFrame, key: str, child: Column, out: str, *more: Column) -> DataFrame:
    """Children of each key, and of each value of ``more``, as one array: ``(key, *more, out)``.

    Children are dealt by key first and gathered there: gathered before, in parts, they would be sorted, and spilled, twice.
    """
    rows = df.select(key, *more, child.alias(out))
    keys = [c for c in rows.columns if c != out]
    return rows.repartition(exchange_tasks(df.sparkSession), *keys).groupBy(*keys).agg(F.collect_list(out).alias(out))


def turn_records(spark: SparkSession, sf_dir: str, child: Column, out: str) -> DataFrame:
    """Conversations as records of consecutive turns, a thousand numbers each: a record is bounded by its rule."""
    return nest(table(spark, sf_dir, "conversations"), "conv_id", child, out, F.floor(F.col("turn") / 1000).alias("part"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each order as one array: a record of the feed is one line of JSON, whatever it holds."""
    lineitem = table(spark, sf_dir, "lineitem")
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    rows = (lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
                    .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
                    .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    child = F.struct("l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "p_partkey",
                     "p_name", "p_size", "p_type", "s_name", "s_nationkey", "n_name")
    return nest(rows, "l_orderkey", child, "lines")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "orders")
            .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _sequence(line: Column) -> Column:
    """Affiliation number: by supplier, so that a number has few affiliations even in a very long order."""
    return (line["l_suppkey"] % 30000).cast("int")


def _author(line: Column) -> Column:
    number = line["l_linenumber"]
    return F.struct(
        F.when(line["l_suppkey"] % 10 != 0, line["l_suppkey"]).alias("author_id"),
        number.cast("int").alias("author_position"),
        F.concat(F.lit("G"), _text(number)).alias("given_name"), line["s_name"].alias("family_name"),
        F.when(number == 1, F.lit("Al")).otherwise(F.lit("Alexander")).alias("pn_given_name"),
        line["s_name"].alias("pn_family_name"), F.array(_sequence(line)).alias("affiliation_sequences"))


def _affiliation(line: Column) -> Column:
    number = line["l_linenumber"]
    ids = F.array(line["s_nationkey"].cast("bigint"), line["l_suppkey"])
    long_name = F.array(line["n_name"], F.rpad(F.lit("x"), 800, "x"))
    return F.struct(
        _sequence(line).alias("affiliation_sequence"),
        F.when(number == 7, F.array().cast("array<bigint>")).otherwise(ids).alias("affiliation_ids"),
        F.array(line["n_name"]).alias("affiliation_normalized"),
        F.struct(
            F.when(number == 6, long_name).otherwise(F.array(line["n_name"])).alias("affiliation_organization"),
            F.concat(F.lit("Dock|"), _text(line["s_nationkey"])).alias("affiliation_address_part"),
            F.substring(line["n_name"], 1, 2).alias("country_code"),
            F.when(number % 2 == 0, F.lit("ST")).alias("affiliation_state"),
            line["n_name"].alias("affiliation_city"),
            F.lit(None).cast("string").alias("affiliation_postal_code")).alias("affiliation_text"))


def _mention(line: Column) -> Column:
    def model(name: str, score: Column) -> Column:
        return F.struct(F.lit(name).alias("model"), score.alias("score"))

    snippets = F.array(line["l_returnflag"], F.lit(""), F.lit("Not Available"))
    models = F.array(model("model1", line["l_discount"]), model("model2", line["l_tax"]))
    with_unknown = F.concat(models, F.array(model("modelX", F.lit(0.0))))
    alias = F.struct(line["p_name"].alias("alias"), (line["p_size"] + 1000).cast("bigint").alias("alias_id"),
                     line["l_discount"].alias("fuzzy_score"), (line["l_discount"] > 0.05).alias("is_fuzzy"))
    return F.struct(
        line["p_name"].alias("identified_dataset_name"),
        F.when(line["l_linenumber"] == 7, F.array().cast("array<string>")).otherwise(snippets).alias("snippets"),
        F.when(line["l_quantity"] > 45, with_unknown).otherwise(models).alias("models"),
        F.when(line["p_size"] <= 40, alias).alias("linked_alias"))


def _asjc(line: Column) -> Column:
    code = F.when(line["p_size"] < 5, F.lpad(_text(line["p_size"]), 4, "0")).otherwise(_text(line["p_size"] + 1000))
    return F.struct(code.alias("asjc"), line["p_type"].alias("label"))


def _concept(line: Column) -> Column:
    return F.struct(line["p_partkey"].alias("concept_id"), line["p_name"].alias("concept_name"),
                    line["l_discount"].alias("rank"), line["l_quantity"].cast("int").alias("a_freq"))


def nested_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with ``agency`` and ``version`` (the order status): a record for every order, with lines or without."""
    lines = _lines(spark, sf_dir)
    rows = _orders(spark, sf_dir).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key, nation, region = F.col("o_orderkey"), F.col("c_nationkey"), F.col("n_regionkey")
    close = F.when(key % 2 == 0, F.lit(1.233)).otherwise(F.lit(1.234))
    score = F.struct(F.when(nation == 5, close).otherwise(region + F.lit(0.5)).alias("citescore_value"))

    def children(build) -> Column:
        return F.transform("lines", build)

    return rows.select(
        F.lit(AGENCY).alias("agency"), F.col("o_orderstatus").alias("version"),
        F.concat(F.lit("2-s2.0-"), _text(key)).alias("eid"),
        F.when(key % 13 != 0, F.concat(F.lit("10.5555/"), _text(key))).alias("doi"),
        F.concat("o_orderpriority", F.lit(" "), _text(key)).alias("publication_title"),
        F.col("o_orderstatus").alias("publication_type"),
        F.year("o_orderdate").alias("publication_year"), F.month("o_orderdate").alias("publication_month"),
        (key % 50).cast("int").alias("citation_count"), F.col("o_totalprice").alias("field_weighted_citation_impact"),
        F.when(F.col("r_name") != "AFRICA", F.col("r_name")).alias("journal_publishername"),
        F.col("c_mktsegment").alias("journal_title"),
        F.when(nation != 24, nation.cast("bigint")).alias("journal_scopus_source_id"),
        F.array(F.concat(F.lit("I"), _text(nation)), F.lit(""), F.concat(F.lit("S"), _text(nation)))
         .alias("journal_issn_isbn"),
        F.when(nation % 7 != 0, score).alias("journal_citescore"),
        F.array("o_orderpriority").alias("expressions"),
        children(_mention).alias("identified_datasets"), children(_author).alias("authors"),
        children(_affiliation).alias("affiliations"), children(_asjc).alias("asjcs"),
        F.when(nation % 11 != 0, F.struct(
            nation.cast("bigint").alias("topic_id"), F.array("c_mktsegment", "n_name").alias("keywords"),
            region.cast("double").alias("prominence"))).alias("topic"),
        F.struct(F.array("r_name").alias("keywords"), region.cast("bigint").alias("cluster_id")).alias("topic_cluster"),
        children(_concept).alias("unified_fingerprint_concepts"))


def alias_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases per run: a child per part size (every ninth left out), and five parents that are their own parent."""
    sizes = table(spark, sf_dir, "part").select("p_size").distinct().where("p_size <= 40 and p_size % 9 <> 0")
    children = sizes.select(
        (F.col("p_size") + 1000).cast("bigint").alias("alias_id"), F.concat(F.lit("size-"), _text("p_size")).alias("alias"),
        (F.col("p_size") % 5 + 1).cast("bigint").alias("parent_alias_id"), F.lit("alias").alias("alias_type"))
    parents = spark.range(1, 6).select(
        F.col("id").alias("alias_id"), F.concat(F.lit("group-"), _text("id")).alias("alias"),
        F.col("id").alias("parent_alias_id"), F.lit("parent").alias("alias_type"))
    return run_keys(spark, sf_dir).crossJoin(F.broadcast(children.unionByName(parents)))


def run_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs: agency and order status, numbered by name. One row per run."""
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("version")).distinct()
    return runs.selectExpr("cast(dense_rank() over (order by version) as bigint) as run_id",
                           f"'{AGENCY}' as agency", "version")


def stated_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per run and year as metadata would state them, and a year 3000 without documents."""
    counts = (table(spark, sf_dir, "orders")
              .groupBy(F.lit(AGENCY).alias("agency"), F.col("o_orderstatus").alias("version"),
                       F.year("o_orderdate").alias("publication_year"))
              .agg(F.count(F.lit(1)).alias("expected")))
    none = run_keys(spark, sf_dir).select("agency", "version", F.lit(3000).alias("publication_year"),
                                          F.lit(0).cast("bigint").alias("expected"))
    return counts.unionByName(none)
