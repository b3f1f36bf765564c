
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The file may be loaded by its path, from any folder.
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parityline.functions.names import base_name, schema_part, source_name, staging_name
from parityline.functions.text import SQL_KEYWORDS, section_end_forms
from parityline.operators import (
    compare,
    keys,
    manifest,
    sampling,
    schema,
    tickets,
    views,
)
from parityline.plans.bindings import table, view, with_clause
from parityline.plans.inventory import named_targets
from parityline.session import shared_path
from parityline.sinks import manifest as manifest_files
from parityline.sinks import staging
from parityline.sources import catalog, documents
from parityline.sources.tickets import EXPORT_COLUMNS, load_tickets, project_tickets

try:  # these operators and the pipeline may be left out, but not what they need
    import corpus_pipeline
    from parityline.llm import queries as training_data
except ImportError as error:
    if error.name not in ("corpus_pipeline", "parityline.llm"):
        raise
    corpus_pipeline = training_data = None

PREFIX = "legacy.src_"
SMOKE_DIR = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]


def _list(text: Column) -> Column:
    """Comma-separated text as an array; '' is the empty array."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))


def _text(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


def _tickets(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tickets")
    return rows.withColumn("eds_schema", schema_part(F.col("eds_equivalent_table")))


def _ingestion_keys(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "ingestion_keys").select(
        F.col("tbl").alias("table"), _list(F.col("key_cols")).alias("key_cols")
    )


def _view_keys(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "view_keys").select(
        "view_table", _list(F.col("view_key_cols")).alias("view_key_cols")
    )


def _targets(spark: SparkSession, sf: str) -> DataFrame:
    return named_targets(_tickets(spark, sf), PREFIX)


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    return keys.attach_keys(_targets(spark, sf), _ingestion_keys(spark, sf), _view_keys(spark, sf))


def _export(spark: SparkSession, sf: str) -> DataFrame:
    """Tickets under the headers of a ticket export."""
    headers = {name: header for header, name in EXPORT_COLUMNS.items()}
    return view(spark, sf, "tickets").withColumnsRenamed(headers)


def _schema_rows(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "schema_rows").withColumn("type_id", F.col("type"))


def _models(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "models").select(
        "path",
        "schema",
        F.col("tbl").alias("table"),
        "description",
        F.split("cols", ",").alias("columns"),
    )


def _manifest_columns(df: DataFrame) -> DataFrame:
    return df.select(*[_text(c) if c == "primary_keys" else c for c in df.columns])


def _ratio(*args, **options: bool) -> DataFrame:
    """The match ratio; counts fit a long at these sizes, as in the SQL."""
    found = compare.match_ratio(*args, **options)
    return found.withColumn("matched_rows", F.col("matched_rows").cast("long"))


def _match(
    left: str = "legacy",
    right: str = "migrated",
    columns: list[str] | None = None,
    **options: bool,
) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        pair = view(spark, sf, left), view(spark, sf, right)
        return _ratio(*pair, ["pk"], columns, **options)

    return run


def _match_dup_pk(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    pk = ["l_orderkey", "l_linenumber"]
    return _ratio(items, items, pk, [*pk, "l_returnflag"])


def _match_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a customer repeat under the customer's key; each counts once at most."""
    items = table(spark, sf, "lineitem")
    returned = items.where("l_returnflag <> 'R' or l_linenumber > 3")
    columns = ["l_orderkey", "l_returnflag"]
    return _ratio(items, returned, ["l_orderkey"], columns, bounded=True)


def _moved(spark: SparkSession, sf: str, side: str) -> DataFrame:
    """Orders with a value in one of two columns; on the right, some in the other one."""
    swap = side == "right"
    key, value = F.col("o_orderkey"), F.col("o_orderpriority")
    other = key % 5 == 0 if swap else F.lit(False)
    return table(spark, sf, "orders").select(
        key.alias("pk"), F.when(~other, value).alias("a"), F.when(other, value).alias("b")
    )


def _match_moved_nulls(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _moved(spark, sf, "left"), _moved(spark, sf, "right")
    return _ratio(left, right, ["pk"], null_safe=True, wide=True)


def _zeros(spark: SparkSession, sf: str, side: str) -> DataFrame:
    """A third of the amounts are zero: 0.0 on the left, -0.0 on the right."""
    zero = 0.0 if side == "left" else -0.0
    amount = F.when(F.col("o_orderkey") % 3 == 0, F.lit(zero)).otherwise(F.col("o_totalprice"))
    changed = F.col("o_totalprice") + F.when(F.col("o_orderkey") % 7 == 0, 1.0).otherwise(0.0)
    if side == "right":
        amount = F.when(F.col("o_orderkey") % 3 == 0, F.lit(zero)).otherwise(changed)
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("pk"), amount.alias("amount"))


def _match_signed_zeros(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _zeros(spark, sf, "left"), _zeros(spark, sf, "right")
    return _ratio(left, right, ["pk"], typed=True, null_safe=True, wide=True)


def _mapped(spark: SparkSession, sf: str, side: str) -> DataFrame:
    """Orders' status and priority as a map, whose entries turn round on the right."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    one = F.create_map(F.lit("status"), status, F.lit("priority"), priority)
    if side == "right":
        lost = F.when(F.col("o_orderkey") % 11 == 0, F.lit("lost")).otherwise(priority)
        one = F.create_map(F.lit("priority"), lost, F.lit("status"), status)
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("pk"), one.alias("m"))


def _match_maps(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _mapped(spark, sf, "left"), _mapped(spark, sf, "right")
    return _ratio(left, right, ["pk"], normalize_maps=True)


def _match_array(spark: SparkSession, sf: str) -> DataFrame:
    """Of some vectors the last component is gone, of others the whole row."""
    vectors = table(spark, sf, "embeddings")
    cut = F.slice("embedding", 1, F.size("embedding") - 1)
    changed = F.when(F.col("vec_id") % 3 == 0, cut).otherwise(F.col("embedding"))
    return _ratio(
        vectors, vectors.where("label <> 0").withColumn("embedding", changed), ["vec_id"]
    )


def _match_empty_left(spark: SparkSession, sf: str) -> DataFrame:
    none = view(spark, sf, "legacy").where(F.col("o_totalprice") < 0)
    return _ratio(none, view(spark, sf, "migrated"), ["pk"])


def _row_hash_match(spark: SparkSession, sf: str) -> DataFrame:
    matches = compare.row_matches(view(spark, sf, "legacy"), view(spark, sf, "migrated"), ["pk"])
    return matches.select("pk", "matched")


def _key_presence(spark: SparkSession, sf: str) -> DataFrame:
    return schema.key_presence(_merged(spark, sf), view(spark, sf, "column_rows"))


def _key_presence_listed(spark: SparkSession, sf: str) -> DataFrame:
    """The check of the whole manifest, by a listing kept in folders of schemas."""
    merged, listing = _merged(spark, sf), shared_path(spark, "columns")
    catalog.write_columns(view(spark, sf, "column_rows"), listing)
    columns = catalog.read_columns(spark, listing, catalog.manifest_schemas(merged))
    return schema.key_presence(merged, columns)


def _presence_columns(checked: DataFrame) -> DataFrame:
    return checked.select(
        "issue_key", "table", "view_table", _text("primary_keys"), "keys_present", "broken"
    )


def _ticket_export(spark: SparkSession, sf: str) -> DataFrame:
    """Tickets written as an export and read from its files."""
    path = shared_path(spark, "export")
    _export(spark, sf).write.csv(path, header=True, escape='"', ignoreTrailingWhiteSpace=False)
    return load_tickets(spark, path)


def _view_scripts(spark: SparkSession, sf: str) -> DataFrame:
    """Definitions written as scripts of a hundred parts each, listed, read and classified."""
    parts = view(spark, sf, "view_texts").where("view_name like 'part/%'")
    number = F.substring_index("view_name", "/", -1).cast("long")
    lines = F.transform(F.array_sort(F.collect_list(F.struct(number.alias("k"), "sql_text"))), lambda x: x["sql_text"])
    scripts = parts.groupBy(F.expr("cast(substring_index(view_name, '/', -1) as long) div 100").alias("script"))
    path, listing = shared_path(spark, "scripts"), shared_path(spark, "listing")
    scripts.agg(F.array_join(lines, "\n").alias("value")).write.partitionBy("script").text(path)
    files = documents.read_documents(spark, path).select("path")
    files.select(F.substring_index("path", "/", -2)).write.text(listing)
    texts = documents.view_texts(spark, listing, base=path.removeprefix("file://") + "/")
    script = F.regexp_extract("path", "/script=([0-9]+)/", 1).cast("long").alias("script")
    return views.view_complexity(texts.select(script, "sql_text"), "sql_text")


def _manifest_files(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest in its files, of which one schema's are written once more."""
    found, path = manifest.validation_manifest(_merged(spark, sf)), shared_path(spark, "manifest")
    manifest_files.write_manifest(found, path, whole=True)
    manifest_files.write_manifest(found.where("eds_schema = 'silver'"), path)
    schema_ = ", ".join(f"`{c}` {kind}" for c, kind in found.dtypes)
    return manifest_files.read_manifest(spark, path, schema_)


def _view_key_files(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "view-keys")
    manifest_files.write_view_keys(_view_keys(spark, sf), path)
    return manifest_files.read_view_keys(spark, path)


def _sample_percent(spark: SparkSession, sf: str) -> DataFrame:
    """Which rows are drawn is Spark's; that they are the table's, and about a tenth, is not."""
    orders = table(spark, sf, "orders").select(*_ORDER_COLUMNS)
    drawn = sampling.sample_percent(orders, 10, seed=7)
    total = orders.agg(F.count("*").alias("total")).scalar()
    foreign = drawn.join(orders, _ORDER_COLUMNS, "left_anti").agg(F.count("*").alias("n")).scalar()
    counts = drawn.agg(F.count("*").alias("n")).select("n", total.alias("total"), foreign.alias("foreign_rows"))
    close = F.abs(F.col("n") - F.col("total") / 10) <= 6 * F.sqrt(F.col("total") * 0.09)
    return counts.select("total", "foreign_rows", close.alias("as_wanted"))


def _staged_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a table of the catalog, staged twice and read from the staging table."""
    folder = shared_path(spark, "stage")
    database = "parityline_" + folder[-12:]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    table(spark, sf, "orders").write.saveAsTable(f"{database}.orders")
    name = f"{catalog.SESSION_CATALOG}.{database}.orders"
    for columns in (["o_orderkey"], _ORDER_COLUMNS):
        staged = staging.stage_sample(spark, name, columns, 0.01, keys=["o_orderkey"], namespace=database)
    return spark.table(staged)


def _extracted(spark: SparkSession, sf: str) -> DataFrame:
    return views.keys_from_descriptions(_models(spark, sf))


def _complexity(spark: SparkSession, sf: str) -> DataFrame:
    return views.view_complexity(view(spark, sf, "view_texts"), "sql_text")


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: share of legacy orders found after the migration."""
    return queries()["match_ratio"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    """Every operator on the tables in the given folder."""
    more = training_data.queries() | {"pipeline": corpus_pipeline.run} if training_data else {}
    return more | {
        # Row comparison
        "match_ratio": _match(),
        "match_ratio_reverse": _match("migrated", "legacy"),
        "match_ratio_bounded": _match_bounded,
        "match_ratio_null_safe": _match_moved_nulls,
        "match_ratio_typed": _match_signed_zeros,
        "match_ratio_maps": _match_maps,
        "match_ratio_pk_only": _match(columns=["pk"]),
        "match_ratio_dup_pk": _match_dup_pk,
        "match_ratio_array": _match_array,
        "match_ratio_empty_left": _match_empty_left,
        "row_hash_match": _row_hash_match,
        # Schemas
        "shared_schema": lambda s, d: schema.shared_schema(_schema_rows(s, d)),
        "schema_compare": lambda s, d: schema.compare_schemas(_schema_rows(s, d)).drop("left_ordinal"),
        "key_presence": lambda s, d: _presence_columns(_key_presence(s, d)),
        "key_presence_listed": lambda s, d: _presence_columns(_key_presence_listed(s, d)),
        "broken_tables": lambda s, d: schema.broken_tables(_key_presence(s, d)),
        # Tickets
        "ticket_projection": lambda s, d: project_tickets(_export(s, d)),
        "ticket_export": _ticket_export,
        "ticket_target_filter": lambda s, d: tickets.target_tickets(_tickets(s, d)),
        "ticket_nonstandard_names": lambda s, d: tickets.nonstandard_names(_tickets(s, d)),
        "ticket_status_counts": lambda s, d: tickets.status_counts(_tickets(s, d)),
        "ticket_replaced_counts": lambda s, d: tickets.replaced_counts(_tickets(s, d)),
        "ticket_funnel": lambda s, d: tickets.ticket_funnel(_tickets(s, d)),
        # Names
        "qualified_source_name": lambda s, d: _tickets(s, d).select(
            "issue_key", source_name(F.col("edw_table"), PREFIX).alias("edw_table")
        ),
        "standardized_base_name": lambda s, d: _targets(s, d).select("issue_key", "eds_base_table"),
        "standardized_base_name_tidy": lambda s, d: _targets(s, d).select(
            "issue_key", base_name(F.col("eds_equivalent_table"), tidy=True).alias("eds_base_table")
        ),
        "staging_name": lambda s, d: _tickets(s, d).select(
            "issue_key", staging_name(F.col("eds_equivalent_table")).alias("staging_table")
        ),
        # Keys
        "ingestion_keys_flatten": lambda s, d: documents.ingestion_keys(
            view(s, d, "config_files")
        ).select("table", _text("key_cols")),
        "view_keys_flatten": lambda s, d: documents.view_keys(view(s, d, "key_files")).select(
            "view_table", _text("view_key_cols")
        ),
        "join_keys_endswith": lambda s, d: keys.join_ingestion_keys(
            _targets(s, d), _ingestion_keys(s, d)
        ).select("issue_key", "table", _text("key_cols")),
        "join_keys_contains": lambda s, d: keys.join_view_keys(
            _targets(s, d), _view_keys(s, d)
        ).select("issue_key", "view_table", _text("view_key_cols")),
        "join_keys_listed": lambda s, d: keys.join_view_keys(
            _targets(s, d), _view_keys(s, d), exact=True
        ).select("issue_key", "view_table", _text("view_key_cols")),
        "asset_keys_merged": lambda s, d: _merged(s, d).select(
            "issue_key", "eds_equivalent_table", "table", "view_table", _text("primary_keys")
        ),
        "asset_keys_strict": lambda s, d: keys.attach_keys(
            _targets(s, d),
            _ingestion_keys(s, d),
            _view_keys(s, d),
            exact=True,
            empty_is_missing=True,
        ).select("issue_key", "table", "view_table", _text("primary_keys")),
        "pk_coverage": lambda s, d: keys.pk_coverage(_merged(s, d)),
        # Manifests
        "schema_batches": lambda s, d: manifest.schema_batches(
            manifest.assign_batches(_merged(s, d))
        ),
        "validation_manifest": lambda s, d: _manifest_columns(
            manifest.validation_manifest(_merged(s, d))
        ),
        "manifest_documents": lambda s, d: manifest.batch_documents(
            manifest.validation_manifest(_merged(s, d))
        ),
        "skipped_schemas": lambda s, d: manifest.skipped_schemas(_merged(s, d)),
        "manifest_files": lambda s, d: _manifest_columns(_manifest_files(s, d)),
        # Views
        "view_key_files": lambda s, d: _view_key_files(s, d).select("view_table", _text("view_key_cols")),
        "view_scripts": _view_scripts,
        "view_models": lambda s, d: documents.view_models(view(s, d, "model_files")).select(
            "path", "schema", "table", "description", _text("columns")
        ),
        "pk_from_model_files": lambda s, d: views.view_keys(
            views.keys_from_descriptions(documents.view_models(view(s, d, "model_files")))
        ).select("view_table", _text("view_key_cols")),
        "pk_from_description": lambda s, d: _extracted(s, d).select(
            "view_table", _text("view_key_cols")
        ),
        "pk_from_description_words": lambda s, d: views.keys_from_descriptions(
            _models(s, d), whole_words=True
        ).select("view_table", _text("view_key_cols")),
        "pk_extraction_counts": lambda s, d: views.extraction_counts(_extracted(s, d)),
        "view_complexity": _complexity,
        "view_complexity_loose": lambda s, d: views.view_complexity(
            view(s, d, "view_texts"), "sql_text", loose=True
        ),
        "view_complexity_counts": lambda s, d: views.complexity_counts(_complexity(s, d)),
        # Samples
        "sample_row_budget": lambda s, d: sampling.sample_row_budget(
            table(s, d, "orders"), _ORDER_COLUMNS, 1
        ),
        "sample_rows": lambda s, d: sampling.sample_rows(
            table(s, d, "orders").select(*_ORDER_COLUMNS), 500, ["o_orderkey"]
        ),
        "sample_rows_copies": lambda s, d: sampling.sample_rows(
            table(s, d, "lineitem").select("l_returnflag", "l_linestatus"), 1234
        ),
        "sample_to_size": lambda s, d: sampling.sample_to_size(
            table(s, d, "orders"), _ORDER_COLUMNS, 0.01, keys=["o_orderkey"]
        ),
        "sample_percent": _sample_percent,
        "staged_sample": _staged_sample,
    }


def _done_cte(*names: str) -> str:
    """Ticket views, then finished and target tickets with their names."""
    return f"""
        {with_clause("tickets", *names)},
        done AS (
          SELECT edw_table AS short_name, concat('{PREFIX}', edw_table) AS edw_table,
                 coalesce(eds_equivalent_table, 'not_updated') AS eds, status,
                 coalesce(is_table_replaced, 'not_updated') AS rep, issue_key,
                 CASE WHEN contains(eds_equivalent_table, '.')
                      THEN split_part(eds_equivalent_table, '.', 2) END AS eds_schema
          FROM tickets WHERE status = 'Done'),
        target AS (
          SELECT *, regexp_replace(replace(replace(replace(eds,
                      'silver', 'silver_base'), 'gold', 'gold_base'), 'bronze', 'bronze_base'),
                      '_vw$', '') AS base
          FROM done
          WHERE rep IN ('No', 'not_updated') AND eds <> 'not_updated' AND eds NOT LIKE '%static%')"""


_ENDS = "right(t.eds, length(i.tbl) + 4) = concat('.', i.tbl, '_vw')"


def _merged_cte(*names: str) -> str:
    return f"""
        {_done_cte("ingestion_keys", "view_keys", *names)},
        merged AS (
          SELECT t.*, i.tbl, v.view_table, coalesce(i.key_cols, v.view_key_cols) AS pks
          FROM target t
          LEFT JOIN ingestion_keys i ON {_ENDS}
          LEFT JOIN view_keys v ON contains(t.eds, v.view_table))"""


def _batched_cte() -> str:
    return f"""
        {_merged_cte()},
        batched AS (
          SELECT *, CAST(floor(row_number() OVER (PARTITION BY eds_schema ORDER BY
                   CASE WHEN pks IS NULL THEN 1 ELSE 0 END,
                   md5(concat_ws('|', issue_key, tbl, view_table)), issue_key,
                   tbl NULLS FIRST, view_table NULLS FIRST, pks) / 20) AS INTEGER) AS batch_id
          FROM merged WHERE NOT contains(eds_schema, '/'))"""


_HASHED = ("o_custkey", "st", "o_totalprice", "o_orderdate")


def _ratio_sql(ctes: str, left: str, right: str, keys_: list[str], hashed: tuple[str, ...]) -> str:
    on = " AND ".join(
        [f"l.{k} = r.{k}" for k in keys_] + [f"l.{c} IS NOT DISTINCT FROM r.{c}" for c in hashed]
    )
    return f"""
        {ctes}
        SELECT CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE m::DOUBLE / n END AS ratio,
               n AS left_rows, m AS matched_rows
        FROM (SELECT (SELECT count(*) FROM {left}) AS n,
                     (SELECT count(*) FROM {left} l JOIN {right} r ON {on}) AS m)"""


def _schema_cte() -> str:
    return f"""
        {with_clause("schema_rows")},
        classes AS (
          SELECT coalesce(l.pair_id, r.pair_id) AS pair_id, coalesce(l.name, r.name) AS name,
                 CASE WHEN r.name IS NULL THEN 'df1_only' WHEN l.name IS NULL THEN 'df2_only'
                      WHEN l.type = r.type THEN 'same_types' ELSE 'diff_types' END AS class,
                 l.type AS left_type, r.type AS right_type, l.ordinal AS left_ordinal
          FROM (SELECT * FROM schema_rows WHERE side = 'left') l
          FULL JOIN (SELECT * FROM schema_rows WHERE side = 'right') r
            ON l.pair_id = r.pair_id AND l.name = r.name)"""


def _presence_cte() -> str:
    found = " AND ".join(f"list_has_all(c{i}.cols, string_split(pks, ','))" for i in range(3))
    missing = " OR ".join(f"c{i}.cols IS NULL" for i in range(3))
    joins = " ".join(
        f"LEFT JOIN cols c{i} ON c{i}.table_name = m.{name}"
        for i, name in enumerate(("edw_table", "eds", "base"))
    )
    return f"""
        {_merged_cte("column_rows")},
        cols AS (SELECT table_name, list(column_name) AS cols FROM column_rows GROUP BY table_name),
        checked AS (
          SELECT issue_key, m.eds AS eds, tbl, view_table, pks,
                 CASE WHEN pks IS NULL THEN FALSE WHEN pks = '' THEN TRUE
                      WHEN {missing} THEN FALSE ELSE {found} END AS keys_present,
                 CASE WHEN pks IS NULL THEN TRUE WHEN pks = '' THEN FALSE
                      ELSE {missing} END AS broken
          FROM merged m {joins})"""


def _extraction_cte(whole_words: bool = False) -> str:
    heading = "Primary Key"
    tail = f"right(description, instr(reverse(description), '{heading[::-1]}') - 1)"
    section = f"""concat('{heading}',
                regexp_replace({tail}, '(?s)({'|'.join(section_end_forms())}).*', ''))"""
    named = f"contains({section}, c)"
    if whole_words:
        named = f"list_contains(regexp_split_to_array({section}, '[^A-Za-z0-9_]+'), c)"
    return f"""
        {with_clause("models")},
        extracted AS (
          SELECT concat(schema, '.', tbl) AS view_table,
                 CASE WHEN contains(description, '{heading}')
                      THEN list_filter(string_split(cols, ','), lambda c: {named}) ELSE [] END AS found
          FROM models)"""


_SCRIPTS = """scripts AS (
        SELECT CAST(k // 100 AS VARCHAR) AS view_name, string_agg(sql_text, chr(10) ORDER BY k) AS sql_text
        FROM (SELECT CAST(split_part(view_name, '/', 2) AS BIGINT) AS k, sql_text
              FROM view_texts WHERE view_name LIKE 'part/%') GROUP BY k // 100)"""


def _complexity_cte(loose: bool = False, source: str = "view_texts") -> str:
    words = sorted(SQL_KEYWORDS, key=lambda w: -w.count(" ")) if loose else SQL_KEYWORDS
    upper = "" if loose else " OR contains(code, ' {u} ')"
    cases = " ".join(
        f"WHEN contains(code, ' {w} '){upper.format(u=w.upper())} THEN '{w}'" for w in words
    )
    code = """array_to_string(list_filter(string_split(sql_text, chr(10)),
                lambda x: NOT contains(x, '--')), chr(10))"""
    if loose:
        code = rf"concat(' ', regexp_replace(lower({code}), '[\s(),;]+', ' ', 'g'), ' ')"
    return f"""
        {with_clause("view_texts")}, {_SCRIPTS},
        stripped AS (SELECT view_name, {code} AS code FROM {source}),
        classified AS (SELECT view_name, CASE {cases} END AS keyword FROM stripped)"""


_ORDER_DIGEST = f"md5(concat_ws('|', {', '.join(_ORDER_COLUMNS)}))"


def _budget_cte(size_mb: float) -> str:
    """The tables here have fewer files than a probe, so all rows are weighed."""
    size = " + ".join(f"strlen(CAST({c} AS VARCHAR))" for c in _ORDER_COLUMNS)
    return f"""
        WITH budget AS (
          SELECT count(*) AS probed_rows, sum({size})::DOUBLE / count(*) AS avg_row_bytes,
                 CAST(floor({size_mb * 1024 * 1024} / (sum({size})::DOUBLE / count(*))) AS BIGINT)
                   AS row_budget, 0.0::DOUBLE AS relative_error
          FROM orders)"""


def _listed_cte() -> str:
    return f"""
        {_done_cte("ingestion_keys", "view_keys")},
        listed AS (
          SELECT DISTINCT eds, array_to_string(list_slice(string_split(trim(one, ' '), '.'), -2, -1),
                   '.') AS piece
          FROM (SELECT eds, unnest(string_split(eds, '/')) AS one FROM target)),
        hits AS (SELECT eds, view_table, view_key_cols FROM listed JOIN view_keys ON piece = view_table)"""


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB SQL on the same tables."""
    more = training_data.oracle_sql() if training_data else {}
    b2 = with_clause("legacy", "migrated")
    dup = ["l_orderkey", "l_linenumber"]
    ticket_columns = "edw_table, eds_equivalent_table, status, is_table_replaced, issue_key"
    schema_of = """CASE WHEN contains(eds_equivalent_table, '.')
                        THEN split_part(eds_equivalent_table, '.', 2) END AS eds_schema"""
    target_columns = """edw_table, eds AS eds_equivalent_table, status,
                        rep AS is_table_replaced, issue_key, eds_schema"""
    order_columns = ", ".join(_ORDER_COLUMNS)
    tidy_part = r"""regexp_replace(regexp_replace(trim(x, ' '),
                      '\.(silver|gold|bronze)\.', '.\1_base.', 'g'), '_vw$', '')"""
    to_size = f"""{_budget_cte(0.01)},
            ordered AS (SELECT *, row_number() OVER (ORDER BY {_ORDER_DIGEST}) AS n
                        FROM orders)
            SELECT {order_columns} FROM ordered WHERE n <= (SELECT row_budget FROM budget)"""
    presence = f"""{_presence_cte()}
            SELECT issue_key, tbl AS "table", view_table, pks AS primary_keys, keys_present, broken
            FROM checked"""
    projection = f"{with_clause('tickets')} SELECT {ticket_columns}, {schema_of} FROM tickets"
    manifest_rows = f"""{_batched_cte()}
            SELECT {target_columns}, base AS eds_base_table, tbl AS "table", view_table,
                   pks AS primary_keys, batch_id
            FROM batched WHERE pks IS NOT NULL"""
    return more | {
        "match_ratio": _ratio_sql(b2, "legacy", "migrated", ["pk"], _HASHED),
        "match_ratio_reverse": _ratio_sql(b2, "migrated", "legacy", ["pk"], _HASHED),
        "match_ratio_bounded": """
            SELECT m::DOUBLE / n AS ratio, n AS left_rows, m AS matched_rows
            FROM (SELECT count(*) AS n, count_if(EXISTS (
                    SELECT 1 FROM lineitem r WHERE (r.l_returnflag <> 'R' OR r.l_linenumber > 3)
                      AND r.l_orderkey = l.l_orderkey AND r.l_returnflag = l.l_returnflag))::BIGINT AS m
                  FROM lineitem l)""",
        "match_ratio_null_safe": _ratio_sql(
            """WITH l_ AS (SELECT o_orderkey AS pk, o_orderpriority AS a, NULL::VARCHAR AS b FROM orders),
            r_ AS (SELECT o_orderkey AS pk, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS a,
                     CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END AS b FROM orders)""",
            "l_", "r_", ["pk"], ("a", "b"),
        ),
        "match_ratio_typed": _ratio_sql(
            """WITH l_ AS (SELECT o_orderkey AS pk,
                     CASE WHEN o_orderkey % 3 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS amount FROM orders),
            r_ AS (SELECT o_orderkey AS pk, CASE WHEN o_orderkey % 3 = 0 THEN -0.0::DOUBLE
                     WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS amount FROM orders)""",
            "l_", "r_", ["pk"], ("amount",),
        ),
        "match_ratio_maps": _ratio_sql(
            """WITH l_ AS (SELECT o_orderkey AS pk, o_orderstatus AS s, o_orderpriority AS p FROM orders),
            r_ AS (SELECT o_orderkey AS pk, o_orderstatus AS s,
                     CASE WHEN o_orderkey % 11 = 0 THEN 'lost' ELSE o_orderpriority END AS p FROM orders)""",
            "l_", "r_", ["pk"], ("s", "p"),
        ),
        "match_ratio_pk_only": _ratio_sql(b2, "legacy", "migrated", ["pk"], ()),
        "match_ratio_dup_pk": _ratio_sql("", "lineitem", "lineitem", dup, ("l_returnflag",)),
        "match_ratio_array": _ratio_sql(
            """WITH other AS (SELECT vec_id, label, CASE WHEN vec_id % 3 = 0
                   THEN embedding[1:len(embedding) - 1] ELSE embedding END AS embedding
                 FROM embeddings WHERE label <> 0)""",
            "embeddings", "other", ["vec_id"], ("embedding", "label"),
        ),
        "match_ratio_empty_left": _ratio_sql(
            b2 + ", none AS (SELECT * FROM legacy WHERE o_totalprice < 0)",
            "none", "migrated", ["pk"], _HASHED,
        ),
        "row_hash_match": f"""
            {b2}
            SELECT l.pk, bool_or(r.pk IS NOT NULL) AS matched
            FROM legacy l LEFT JOIN migrated r ON l.pk = r.pk
              AND {" AND ".join(f"l.{c} IS NOT DISTINCT FROM r.{c}" for c in _HASHED)}
            WHERE l.pk IS NOT NULL GROUP BY l.pk""",
        "shared_schema": f"""{_schema_cte()}
            SELECT pair_id, name, left_type AS type, left_ordinal AS ordinal
            FROM classes WHERE class = 'same_types'""",
        "schema_compare": f"{_schema_cte()} SELECT * EXCLUDE (left_ordinal) FROM classes",
        "key_presence": presence,
        "key_presence_listed": presence,
        "broken_tables": f"""{_presence_cte()}
            SELECT DISTINCT eds AS eds_equivalent_table FROM checked WHERE broken""",
        "ticket_projection": projection,
        "ticket_export": projection,
        "ticket_target_filter": f"""{_done_cte()}
            SELECT {target_columns.replace("edw_table", "short_name AS edw_table", 1)} FROM target""",
        "ticket_nonstandard_names": f"""{with_clause("tickets")}
            SELECT {ticket_columns}, {schema_of} FROM tickets
            WHERE left(eds_equivalent_table, 1) <> 'p'""",
        "ticket_status_counts": f"""{with_clause("tickets")}
            SELECT status, count(*) AS tickets FROM tickets GROUP BY status""",
        "ticket_replaced_counts": f"""{_done_cte()}
            SELECT rep AS is_table_replaced, count(*) AS tickets
            FROM done WHERE eds <> 'not_updated' GROUP BY rep""",
        "ticket_funnel": f"""{_done_cte()}
            SELECT (SELECT count(*) FROM tickets) AS total,
                   (SELECT count(*) FROM done) AS done,
                   (SELECT count(*) FROM tickets WHERE status = 'Won''t Do') AS wont_do,
                   count_if(eds = 'not_updated')::BIGINT AS name_missing,
                   count_if(eds <> 'not_updated')::BIGINT AS name_present,
                   count_if(eds <> 'not_updated' AND rep = 'Yes')::BIGINT AS replaced,
                   count_if(eds <> 'not_updated' AND rep = 'No')::BIGINT AS not_replaced,
                   count_if(eds <> 'not_updated' AND rep = 'not_updated')::BIGINT AS replaced_unknown,
                   (SELECT count(*) FROM target) AS target
            FROM done""",
        "qualified_source_name": f"""{with_clause("tickets")}
            SELECT issue_key, concat('{PREFIX}', edw_table) AS edw_table FROM tickets""",
        "standardized_base_name": f"{_done_cte()} SELECT issue_key, base AS eds_base_table FROM target",
        "standardized_base_name_tidy": f"""{_done_cte()}
            SELECT issue_key, array_to_string(list_transform(string_split(eds, '/'),
                     lambda x: {tidy_part}), '/') AS eds_base_table
            FROM target""",
        "staging_name": f"""{with_clause("tickets")}
            SELECT issue_key,
                   CASE WHEN len(string_split(eds_equivalent_table, '.')) = 3
                        THEN concat('dev.general.', split_part(eds_equivalent_table, '.', 2), '_',
                                    split_part(eds_equivalent_table, '.', 3), '_cw') END AS staging_table
            FROM tickets""",
        "ingestion_keys_flatten": f"""{with_clause("assets")}
            SELECT nm AS "table", CASE p_size % 4 WHEN 0 THEN 'id,ts' WHEN 1 THEN 'sid'
                                                  ELSE '' END AS key_cols FROM assets
            UNION ALL SELECT 'NO TABLE', concat(layer, '_id') FROM assets""",
        "view_keys_flatten": f"""{with_clause("key_files")}
            SELECT unnest(json_keys(content)) AS view_table,
                   array_to_string(unnest(list_transform(json_keys(content),
                     lambda k: from_json(json_extract(content, concat('$."', k, '"')),
                                         '["VARCHAR"]'))), ',') AS view_key_cols
            FROM key_files""",
        "join_keys_endswith": f"""{_done_cte("ingestion_keys")}
            SELECT issue_key, i.tbl AS "table", i.key_cols
            FROM target t LEFT JOIN ingestion_keys i ON {_ENDS}""",
        "join_keys_contains": f"""{_done_cte("view_keys")}
            SELECT issue_key, view_table, view_key_cols
            FROM target t LEFT JOIN view_keys v ON contains(t.eds, v.view_table)""",
        "join_keys_listed": f"""{_listed_cte()}
            SELECT issue_key, view_table, view_key_cols
            FROM target t LEFT JOIN hits h ON t.eds = h.eds""",
        "asset_keys_strict": f"""{_listed_cte()}
            SELECT issue_key, i.tbl AS "table", view_table,
                   coalesce(nullif(i.key_cols, ''), nullif(view_key_cols, '')) AS primary_keys
            FROM target t LEFT JOIN ingestion_keys i ON {_ENDS} LEFT JOIN hits h ON t.eds = h.eds""",
        "asset_keys_merged": f"""{_merged_cte()}
            SELECT issue_key, eds AS eds_equivalent_table, tbl AS "table", view_table,
                   pks AS primary_keys FROM merged""",
        "pk_coverage": f"""{_merged_cte()}
            SELECT count(*) AS total, count(pks) AS with_pk, count(*) - count(pks) AS without_pk
            FROM merged""",
        "schema_batches": f"""{_batched_cte()}
            SELECT eds_schema, batch_id, count(*) AS rows, count(pks) AS rows_with_key
            FROM batched GROUP BY eds_schema, batch_id""",
        "validation_manifest": manifest_rows,
        "manifest_files": manifest_rows,
        "manifest_documents": f"""{_batched_cte()}
            SELECT eds_schema, batch_id, CAST(to_json(list(struct_pack(
                     edw_table := edw_table, eds_equivalent_table := eds, status := status,
                     is_table_replaced := rep, issue_key := issue_key, eds_schema := eds_schema,
                     eds_base_table := base, "table" := tbl, view_table := view_table,
                     primary_keys := list_filter(string_split(pks, ','), lambda c: c <> ''),
                     batch_id := batch_id)
                   ORDER BY CASE rep WHEN 'No' THEN 0 ELSE 1 END, issue_key, tbl NULLS FIRST,
                            view_table NULLS FIRST, pks)) AS VARCHAR) AS document
            FROM batched WHERE pks IS NOT NULL GROUP BY eds_schema, batch_id""",
        "skipped_schemas": f"""{_merged_cte()}
            SELECT count_if(eds_schema IS NULL)::BIGINT AS null_schema,
                   count_if(contains(eds_schema, '/'))::BIGINT AS mixed_schema FROM merged""",
        "view_models": f"""{with_clause("assets")}
            SELECT concat('repo/', layer, '.mart/models/', nm, '.v1.yml') AS path, layer AS schema,
                   nm AS "table", concat('About ', nm, '. Primary Key: id') AS description,
                   CASE WHEN p_size > 10 THEN concat('id,', layer) END AS columns
            FROM assets""",
        "pk_from_model_files": f"""{with_clause("assets")}
            SELECT concat(layer, '.', nm) AS view_table, 'id' AS view_key_cols
            FROM assets WHERE p_size > 10""",
        "pk_from_description": f"""{_extraction_cte()}
            SELECT view_table, CASE WHEN len(found) > 0 THEN array_to_string(found, ',') END
                     AS view_key_cols FROM extracted""",
        "pk_from_description_words": f"""{_extraction_cte(whole_words=True)}
            SELECT view_table, CASE WHEN len(found) > 0 THEN array_to_string(found, ',') END
                     AS view_key_cols FROM extracted""",
        "pk_extraction_counts": f"""{_extraction_cte()}
            SELECT count_if(len(found) > 0)::BIGINT AS found,
                   count_if(len(found) = 0)::BIGINT AS not_found FROM extracted""",
        "view_complexity": f"{_complexity_cte()} SELECT * FROM classified",
        "view_complexity_loose": f"{_complexity_cte(loose=True)} SELECT * FROM classified",
        "view_complexity_counts": f"""{_complexity_cte()}
            SELECT count(*) AS views, count(keyword) AS non_select_views FROM classified""",
        "sample_row_budget": f"{_budget_cte(1)} SELECT * FROM budget",
        "sample_rows": f"""
            SELECT {order_columns} FROM orders ORDER BY {_ORDER_DIGEST} LIMIT 500""",
        "sample_rows_copies": """
            SELECT l_returnflag, l_linestatus FROM lineitem
            ORDER BY md5(concat_ws('|', l_returnflag, l_linestatus)) LIMIT 1234""",
        "sample_to_size": to_size,
        "staged_sample": to_size,
        "sample_percent": """
            SELECT count(*) AS total, 0::BIGINT AS foreign_rows, TRUE AS as_wanted FROM orders""",
        "view_key_files": f"{with_clause('view_keys')} SELECT * FROM view_keys",
        "view_scripts": f"""{_complexity_cte(source="scripts")}
            SELECT CAST(view_name AS BIGINT) AS script, keyword FROM classified""",
    }
