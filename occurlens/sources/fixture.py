"""The ``raw`` occurrence table derived from the benchmark tables.

The benchmark data has no theft reports, so the raw 16-string table is
derived from lineitem x orders x customer x nation x part, one report per
line item, carrying the dirt the cleaning rules must handle (padding, 'NULL'
text, three date formats, hours 24-25, accents, abbreviations, brand
spellings). The projection is plain SQL that Spark and DuckDB both accept,
so the oracle queries reuse exactly the same definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import compiled_stages, table_path

# The projection that defines the fixture (one SQL expression
# per raw column, in raw column order).
RAW_EXPRESSIONS = [
    "case when l_partkey % 61 = 0 then '12d' when l_partkey % 67 = 0 then '12f' when l_partkey % 71 = 0 then '1e3'"
    " when l_partkey % 73 = 0 then concat(cast(year(l_shipdate) as string), '.0')"
    " else cast(year(l_shipdate) as string) end as ANO_BO",
    "cast(l_orderkey as string) as NUM_BO",
    "case when c_nationkey = 24 then 'NULL' when c_nationkey % 3 = 0 then 'S.PAULO      '"
    " else concat(n_name, ' ', cast(c_custkey % 4 as string), '   ') end as NOME_MUNICIPIO_CIRC",
    "case when l_partkey % 97 = 0 then '' when l_partkey % 89 = 0 then 'NULL'"
    " when l_orderkey % 3 = 0 then concat(y,'-',m,'-',d,' 00:00:00')"
    " when l_orderkey % 3 = 1 then concat(y,'-',m,'-',d) else concat(d,'/',m,'/',y) end"
    " as DATA_OCORRENCIA_BO",
    "case when l_partkey % 53 = 0 then '' when l_partkey % 59 = 0 then 'NULL'"
    " else concat(lpad(cast((l_orderkey * 7 + l_linenumber * 5) % 26 as string),2,'0'),':30:00')"
    " end as HORA_OCORRENCIA",
    "case when l_returnflag = 'A' then 'Furto (art. 155)' when l_returnflag = 'R'"
    " then 'ROUBO (art. 157)  ' when l_linestatus = 'O' then 'Furto qualificado (art. 155)'"
    " else 'Outro' end as RUBRICA",
    "case when o_orderstatus = 'O' then 'TENTADO' when o_orderstatus = 'F' then 'Consumado  '"
    " else 'CONSUMADO' end as FLAG_STATUS",
    "case when c_mktsegment = 'MACHINERY' then 'NAO INFORMADO' when c_mktsegment = 'FURNITURE'"
    " then 'N/D' else c_mktsegment end as DESCR_TIPOLOCAL",
    "n_name as CIDADE",
    "case when p_size = 50 then 'NULL' when p_size = 49 then 'Não Informado'"
    " when p_size % 5 = 0 then concat('JD ', p_name) when p_size % 5 = 1 then concat('VL ', p_name)"
    " when p_size % 5 = 2 then concat('Consolação ', p_type)"
    " when p_size % 5 = 3 then concat('CONSOLACAO ', p_type) else p_name end as BAIRRO",
    "case when l_partkey % 41 = 0 then '' when l_partkey % 43 = 0 then '0' else concat('-23.5', cast(l_partkey % 7 as string)) end"
    " as LATITUDE",
    "case when l_partkey % 41 = 0 then '' when l_partkey % 43 = 0 then '0' else concat('-46.6', cast(l_partkey % 3 as string)) end"
    " as LONGITUDE",
    "case when l_orderkey % 997 = 0 then 'ASUS Zenfone' when l_orderkey % 991 = 0 then 'Realme 5' else"
    " case p_brand when 'Brand#1' then 'SAMSUNG GALAXY J5' when 'Brand#2' then 'iPhone 12'"
    " when 'Brand#3' then 'i-phone' when 'Brand#4' then 'Moto G' when 'Brand#5' then 'MOTO'"
    " when 'Brand#6' then 'xiaomi' when 'Brand#7' then 'LG K10' when 'Brand#8' then 'LGK10'"
    " when 'Brand#9' then 'APPLE (capa samsung)' when 'Brand#10' then 'NULL'"
    " when 'Brand#11' then 'nokia ' when 'Brand#12' then 'TCL' else p_brand end end as MARCA_OBJETO",
    "case when l_partkey % 101 = 0 then '' else cast(month(l_shipdate) as string) end as MES",
    "case when l_orderkey % 211 = 0 then '' else cast(year(l_shipdate) as string) end as ANO",
    "concat('f_', cast(year(l_shipdate) as string)) as ARQUIVO_ORIGEM",
]

# Extra source columns for the caught-in-the-act, police-section and
# postal-code operators (the file format has them; the KPIs do not use them).
EXTRA_EXPRESSIONS = [
    "case when l_linenumber = 1 then 'S' when l_orderkey % 11 = 0 then 'NULL' else 'N' end as FLAG_FLAGRANTE",
    "concat('DEL.SEC. ', cast(c_nationkey % 7 as string), ' ') as NOME_SECCIONAL_CIRC",
    "case when c_custkey % 13 = 0 then '' else cast(c_custkey * 7919 % 9000000 as string) end as CEP",
]

# Order date parts used by the date expressions.
ORDER_DATE_PARTS = [
    "cast(year(o_orderdate) as string) as y",
    "lpad(cast(month(o_orderdate) as string),2,'0') as m",
    "lpad(cast(day(o_orderdate) as string),2,'0') as d",
]

# The file whose year and month columns are blank throughout (input of the
# file-level year/month derivation).
BLANK_YEAR_FILE = "f_2001"


def raw_sql(extended: bool = False) -> str:
    """The fixture as one SQL query over the base tables (for DuckDB)."""
    exprs = RAW_EXPRESSIONS + (EXTRA_EXPRESSIONS if extended else [])
    return (
        "select " + ",\n  ".join(exprs) + "\n"
        "from (select l.*, o_orderstatus, o_custkey, " + ", ".join(ORDER_DATE_PARTS) + "\n"
        "      from lineitem l join orders on l_orderkey = o_orderkey) lo\n"
        "join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey\n"
        "join part on l_partkey = p_partkey"
    )


def raw_blank_year_sql() -> str:
    """``raw`` with ANO and MES blank in one whole file (DuckDB form)."""
    return (
        f"select * replace (case when ARQUIVO_ORIGEM = '{BLANK_YEAR_FILE}' then '' else ANO end as ANO,"
        f" case when ARQUIVO_ORIGEM = '{BLANK_YEAR_FILE}' then '' else MES end as MES) from raw"
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cores when its scan has fewer splits than there are cores: a
    single file of one row group would otherwise take the whole join-and-clean stage through one
    task. By row, not by key, so a key with a third of the rows makes no hot task. A large
    table's scan has thousands of splits; nothing is added to it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def raw_from_tables(spark: SparkSession, sf_dir: str, extended: bool = False) -> DataFrame:
    """The 16-string raw table, one row per line item.

    Joins are left to the optimizer: AQE broadcasts a side only when its
    measured size is under the broadcast threshold, else it shuffles on the
    join key. ``nation`` has a fixed 25 rows, so it is broadcast outright.
    Only the referenced columns are read (pruned ReadSchema), and the shuffles carry
    days instead of times, and neither the dates' texts nor the nation's name: those are made after them.
    """
    compiled_stages(spark)
    lineitem = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date")))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")

    lo = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    joined = (lo.join(customer, lo.o_custkey == customer.c_custkey)
              .join(part, lo.l_partkey == part.p_partkey)
              .join(F.broadcast(nation), F.col("c_nationkey") == nation.n_nationkey)
              .selectExpr("*", *ORDER_DATE_PARTS))
    return joined.selectExpr(*RAW_EXPRESSIONS, *(EXTRA_EXPRESSIONS if extended else []))


def raw_blank_year(raw: DataFrame) -> DataFrame:
    """``raw`` with ANO and MES blank in one whole file."""
    blank = F.col("ARQUIVO_ORIGEM") == BLANK_YEAR_FILE
    return raw.withColumns({
        "ANO": F.when(blank, F.lit("")).otherwise(F.col("ANO")),
        "MES": F.when(blank, F.lit("")).otherwise(F.col("MES")),
    })
