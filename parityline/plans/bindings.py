"""Inventory-shaped views over the test tables.

Each entry is SQL that Spark and DuckDB read alike, so a query and its check
start from the same rows. All of them cover their whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("orders", "part", "documents", "pages")

VIEWS = {
    # One asset per part; a third of them share the silver layer.
    "assets": """
        SELECT p_partkey AS k, p_size, p_brand,
               concat(replace(p_name, ' ', '_'), '_', CAST(p_partkey AS string)) AS nm,
               CASE p_type WHEN 'STANDARD' THEN 'gold' WHEN 'PROMO' THEN 'gold_base'
                           WHEN 'MEDIUM' THEN 'bronze' WHEN 'LARGE' THEN 'bi'
                           ELSE 'silver' END AS layer
        FROM part""",
    # One ticket per order, about the asset that the customer's number names.
    "tickets": """
        SELECT concat('core.', nm) AS edw_table,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL
                    WHEN o_orderkey % 11 = 0 THEN concat('prod.static.', nm)
                    WHEN o_orderkey % 13 = 0 THEN nm
                    WHEN o_orderkey % 17 = 0
                      THEN concat('prod.', layer, '.', nm, '_vw/ prod.gold.', nm, '_vw')
                    WHEN o_orderkey % 19 = 0 THEN concat('prod.', layer, '/gold.', nm, '_vw')
                    WHEN o_orderkey % 23 = 0 THEN concat('prod.', layer, '.', nm, '_vw ')
                    ELSE concat('prod.', layer, '.', nm, '_vw') END AS eds_equivalent_table,
               CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'O' THEN 'Won''t Do'
                                  ELSE 'Open' END AS status,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '2-HIGH' THEN 'Yes'
                                    WHEN '5-LOW' THEN NULL ELSE 'No' END AS is_table_replaced,
               concat('T-', CAST(o_orderkey AS string)) AS issue_key
        FROM orders JOIN assets ON o_custkey = k""",
    "ingestion_keys": """
        SELECT nm AS tbl, CASE WHEN p_size % 5 = 0 THEN '' ELSE 'id,ts' END AS key_cols
        FROM assets WHERE p_size >= 25""",
    # The second half are names that are prefixes of others.
    "view_keys": """
        SELECT concat(layer, '.', nm) AS view_table, 'vid' AS view_key_cols
        FROM assets WHERE p_size <= 35
        UNION ALL
        SELECT concat(layer, '.', substr(nm, 1, length(nm) - 1)), 'vid,vid2'
        FROM assets WHERE p_size > 40""",
    "legacy": """
        SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS pk, o_custkey,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS st,
               o_totalprice, o_orderdate, o_custkey AS cust_code, o_orderpriority AS legacy_only
        FROM orders""",
    # Orders after the cut-over are not migrated yet; urgent ones differ in price.
    "migrated": """
        SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS pk, o_custkey,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS st,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1
                    ELSE o_totalprice END AS o_totalprice,
               o_orderdate, CAST(o_custkey AS string) AS cust_code, 'x' AS target_only
        FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'""",
    # The columns of each asset's legacy and migrated table, as schema rows.
    "schema_rows": """
        SELECT nm AS pair_id, 'left' AS side, 'id' AS name, 1 AS ordinal, 'bigint' AS type FROM assets
        UNION ALL SELECT nm, 'left', 'price', 2, 'double' FROM assets
        UNION ALL SELECT nm, 'left', lower(replace(p_brand, '#', '_')), 3, 'string' FROM assets
        UNION ALL SELECT nm, 'left', 'legacy_only', 4, 'date' FROM assets WHERE p_size > 25
        UNION ALL SELECT nm, 'right', 'id', 1, CASE layer WHEN 'gold' THEN 'int' ELSE 'bigint' END
                  FROM assets
        UNION ALL SELECT nm, 'right', 'price', 2,
                         CASE WHEN p_size % 5 = 0 THEN 'decimal(12,2)' ELSE 'double' END FROM assets
        UNION ALL SELECT nm, 'right', CASE layer WHEN 'bi' THEN 'brand'
                                                 ELSE lower(replace(p_brand, '#', '_')) END, 3, 'string'
                  FROM assets
        UNION ALL SELECT nm, 'right', 'loaded_at', 4, 'timestamp' FROM assets WHERE p_size < 40""",
    # A column listing of the tables behind the tickets; bronze has no base tables.
    "column_rows": " UNION ALL ".join(
        f"""
        SELECT concat('legacy.src_core.', nm) AS table_name, '{c}' AS column_name FROM assets
        UNION ALL SELECT concat('prod.', layer, '.', nm, '_vw'), '{c}' FROM assets
        UNION ALL SELECT concat('prod.', CASE layer WHEN 'bi' THEN 'bi'
                                                    ELSE concat(layer, '_base') END, '.', nm), '{c}'
                  FROM assets WHERE layer <> 'bronze' AND ('{c}' <> 'ts' OR p_size < 45)"""
        for c in ("id", "ts", "vid")
    ),
    # View models: short ones from parts, and whole documents as descriptions.
    "models": """
        SELECT concat('repo/mart/models/m_', CAST(p_partkey AS string), '.yml') AS path,
               'mart' AS schema, concat('m_', CAST(p_partkey AS string)) AS tbl,
               concat('Overview of ', p_name,
                 CASE p_partkey % 5
                   WHEN 0 THEN '. Primary Key: order_id, part_id. Not Null: size'
                   WHEN 1 THEN '. Primary Key: part_id'
                   WHEN 2 THEN '. no key here'
                   WHEN 3 THEN '. Primary Key: nothing. Primary Key: order_id data_grain size'
                   ELSE '. Primary Key: unknown' END) AS description,
               'id,order_id,part_id,size' AS cols
        FROM part
        UNION ALL
        SELECT concat('repo/docs/models/d_', CAST(doc_id AS string), '.yml'), 'docs',
               concat('d_', CAST(doc_id AS string)),
               CASE doc_id % 4
                 WHEN 0 THEN concat(text, ' Primary Key: doc_id, lang. NOT_NULL source')
                 WHEN 1 THEN concat('Primary Key from prose: ', text)
                 WHEN 2 THEN text
                 ELSE concat(text, ' Primary Key: n_chars changelog doc_id') END,
               'doc_id,lang,source,n_chars,the,que'
        FROM documents""",
    # View definitions, and whole documents and pages as if they were some.
    "view_texts": """
        SELECT concat('part/', CAST(p_partkey AS string)) AS view_name,
               concat('select a, b from t', CASE p_partkey % 6
                 WHEN 0 THEN ' JOIN u on t.a = u.a'
                 WHEN 1 THEN concat(chr(10), '-- inner join u', chr(10), 'where a > 1')
                 WHEN 2 THEN ' where a in (1, 2)'
                 WHEN 3 THEN ' Left Join u on 1 = 1'
                 WHEN 4 THEN ' where a IS NOT NULL '
                 ELSE concat(' where a = 1 -- note', chr(10), ' union all select 1') END) AS sql_text
        FROM part
        UNION ALL SELECT concat('documents/', CAST(doc_id AS string)), text FROM documents
        UNION ALL SELECT concat('pages/', CAST(page_id AS string)), html FROM pages""",
    # One key config and one view model per part, as YAML; one key object as JSON.
    "config_files": """
        SELECT concat('conf/', CAST(k AS string), '.yml') AS path,
               concat('configurations:', chr(10), '- owner: data', chr(10),
                 '- target_table: ', nm, chr(10),
                 CASE p_size % 4 WHEN 0 THEN concat('  key_columns: [id, ts]', chr(10))
                                 WHEN 1 THEN concat('  key_columns: {snapshots: [sid]}', chr(10))
                                 WHEN 2 THEN concat('  key_columns: []', chr(10)) ELSE '' END,
                 '- key_columns:', chr(10), '  - ', layer, '_id', chr(10)) AS content
        FROM assets""",
    "model_files": """
        SELECT concat('repo/', layer, '.mart/models/', nm, '.v1.yml') AS path,
               concat('models:', chr(10), '- description: "About ', nm, '. Primary Key: id"', chr(10),
                 CASE WHEN p_size > 10 THEN concat('  columns:', chr(10), '  - name: id', chr(10),
                   '  - name: ', layer, chr(10)) ELSE '' END) AS content
        FROM assets""",
    "key_files": """
        SELECT concat('keys/', CAST(k AS string), '.json') AS path,
               concat('{"', layer, '.', nm, '": ["id", "', layer, '_id"], "', layer, '.x_', nm, '": []}') AS content
        FROM assets""",
}

# Which view is built on which.
_NEEDS = {
    "tickets": ("assets",),
    "ingestion_keys": ("assets",),
    "view_keys": ("assets",),
    "schema_rows": ("assets",),
    "column_rows": ("assets",),
    "config_files": ("assets",),
    "model_files": ("assets",),
    "key_files": ("assets",),
}


def with_clause(*names: str) -> str:
    """``WITH`` clause that defines the named views and what they need."""
    ordered: dict[str, None] = {}
    for name in names:
        ordered.update(dict.fromkeys((*_NEEDS.get(name, ()), name)))
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in ordered)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views above, on the tables in ``sf_dir``."""
    query = f"{with_clause(name)} SELECT * FROM {name}"
    for t in TABLES:
        # Views of a name of their own: the caller's session may have an orders view.
        query, uses = re.subn(rf"(FROM|JOIN) {t}\b", rf"\1 _parityline_{t}", query)
        if uses:
            table(spark, sf_dir, t).createOrReplaceTempView(f"_parityline_{t}")
    return spark.sql(query)
