"""Payroll-shaped views derived from the TPC-H-like test tables.

The same definitions exist twice: as DataFrame code (what the engine runs)
and as DuckDB SQL (``DUCKDB_VIEWS``, the oracle's common table expressions).
Modulo expressions below only vary values (name case, NULL keys, position
moves); they never filter rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quincena.sources.tables import read_table


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landing row per order (15,000 at sf0.01), plus ``row_id``."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # nation has a fixed 25 rows: a broadcast of bounded size.
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    joined = o.join(c, ck == F.col("c_custkey")).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        ok.alias("row_id"),
        F.when(ok % 11 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("nombre"),
        F.when(ok % 29 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("apellido"),
        F.concat(F.lit("8-"), _s(ck), F.lit("-"), _s(ck % 97)).alias("cedula"),
        F.when(ok % 37 == 0, F.lit(None).cast("string"))
         .when(ok % 13 == 0, F.concat(F.lit("CARGO_"), _s(ok % 40)))
         .otherwise(F.concat(F.lit("CARGO_"), _s(ck % 40))).alias("cargo"),
        (F.floor(F.col("o_totalprice") / 100000) * 1000).cast("double").alias("salario"),
        F.when(ck % 5 == 0, F.lit(None).cast("double")).otherwise((100 * (ck % 7)).cast("double")).alias("gasto"),
        F.col("o_orderstatus").alias("estado"),
        F.date_add(F.lit("1980-01-31").cast("date"), (ck % 5000).cast("int")).alias("fecha_de_inicio"),
        (F.col("o_orderdate") + F.expr("INTERVAL 870 MINUTES")).alias("fecha_actualizacion"),
        F.date_trunc("quarter", "o_orderdate").cast("timestamp_ntz").alias("fecha_consulta"),
        F.concat(F.lit("reporte_"), _s("n_nationkey")).alias("archivo"),
        F.col("n_name").alias("institucion"),
    )


def audit(spark: SparkSession, sf_dir: str, payroll_df: DataFrame | None = None) -> DataFrame:
    """Polls consistent with the payroll: one per (institution, status, version)."""
    p = payroll_df if payroll_df is not None else payroll(spark, sf_dir)
    g = p.groupBy("institucion", "estado", "fecha_consulta").agg(
        F.max("fecha_actualizacion").alias("checked_at"))
    fail = (F.ascii("estado") + F.month("fecha_consulta") + F.length("institucion")
            + F.regexp_replace("institucion", "NATION_", "").cast("int")) % 7 == 0
    return g.select(
        F.col("institucion").alias("institution_name_spanish"),
        F.col("estado").alias("status_name_spanish"),
        F.when(fail, F.lit("FAIL")).otherwise(F.lit("OK")).alias("run_status"),
        F.col("fecha_consulta").alias("source_update"),
        "checked_at",
    )


def translations(spark: SparkSession, sf_dir: str, payroll_df: DataFrame | None = None) -> DataFrame:
    """Dictionary (spanish, english) with deliberate gaps."""
    p = payroll_df if payroll_df is not None else payroll(spark, sf_dir)
    n = read_table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("spanish"), F.concat(F.lit("Nation "), _s("n_nationkey")).alias("english"))
    st = (read_table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
          .select(F.col("o_orderstatus").alias("spanish")).distinct()
          .select("spanish", F.concat(F.lit("Status "), F.col("spanish")).alias("english")))
    pos = (p.where(F.col("cargo").isNotNull() & ~F.col("cargo").like("%7"))
           .select(F.col("cargo").alias("spanish")).distinct()
           .select("spanish", F.regexp_replace("spanish", "CARGO_", "Position ").alias("english")))
    return n.unionByName(st).unionByName(pos)


def part_names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Names of four words (adjective, noun, type, brand) and a dictionary of
    words, of phrases across them and of a few whole names, with gaps."""
    p = read_table(spark, sf_dir, "part")
    adj, noun = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    name = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    entries = F.array(
        _entry(adj, F.upper(adj), F.length(adj) != 4),
        _entry(noun, F.concat(F.lit("the "), noun), F.lit(True)),
        _entry(F.col("p_name"), F.concat(F.lit("one "), "p_name"), F.length("p_name") % 3 == 0),
        _entry(F.col("p_type"), F.lower("p_type"), F.length("p_type") % 2 == 0),
        _entry(F.concat_ws(" ", noun, "p_type"), F.concat(F.lit("kind "), noun), F.length(noun) % 2 == 1),
        _entry(F.concat_ws(" ", "p_type", "p_brand"), F.lower("p_brand"), F.length("p_brand") == 7),
        _entry(F.col("p_brand"), F.regexp_replace("p_brand", "#", " "), ~F.col("p_brand").like("%7")),
        _entry(name, F.concat(F.lit("entry "), _s("p_partkey")), F.col("p_partkey") % 50 == 0))
    return p.select(name.alias("name")).distinct(), p.select(F.inline(F.filter(entries, lambda e: e["spanish"].isNotNull()))).distinct()


def _entry(spanish, english, known):
    return F.struct(F.when(known, spanish).alias("spanish"), english.alias("english"))


def poll_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring / latest-poll input with unique ``checked_at``."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid.alias("run_id"),
        F.concat(F.lit("INST_"), _s(F.col("user_id") % 25)).alias("institution_name_spanish"),
        F.col("event_type").alias("status_name_spanish"),
        F.when(eid % 10 < 7, F.lit("OK")).when(eid % 10 < 9, F.lit("FAIL"))
         .otherwise(F.lit("No Update")).alias("run_status"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("source_update"),
        F.col("ts").alias("checked_at"),
        F.col("ts").alias("start_at"),
        (F.col("ts") + F.expr("INTERVAL 90 SECONDS")).alias("end_at"),
        F.col("value").cast("double").alias("time"),
    )


# DuckDB form of the same views, used as common table expressions by the oracle SQL.
DUCKDB_VIEWS = """
payroll AS (
 SELECT o_orderkey AS row_id,
  CASE WHEN o_orderkey % 11 = 0 THEN upper(c_name) ELSE c_name END AS nombre,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE c_mktsegment END AS apellido,
  concat('8-', CAST(o_custkey AS VARCHAR), '-', CAST(o_custkey % 97 AS VARCHAR)) AS cedula,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL
       WHEN o_orderkey % 13 = 0 THEN concat('CARGO_', CAST(o_orderkey % 40 AS VARCHAR))
       ELSE concat('CARGO_', CAST(o_custkey % 40 AS VARCHAR)) END AS cargo,
  CAST(floor(o_totalprice / 100000) * 1000 AS DOUBLE) AS salario,
  CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(100 * (o_custkey % 7) AS DOUBLE) END AS gasto,
  o_orderstatus AS estado,
  DATE '1980-01-31' + CAST(o_custkey % 5000 AS INT) AS fecha_de_inicio,
  o_orderdate + INTERVAL '870' MINUTE AS fecha_actualizacion,
  CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS fecha_consulta,
  concat('reporte_', CAST(n_nationkey AS VARCHAR)) AS archivo,
  n_name AS institucion
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
audit AS (
 SELECT institucion AS institution_name_spanish, estado AS status_name_spanish,
  CASE WHEN (ascii(estado) + month(fecha_consulta) + length(institucion)
             + CAST(replace(institucion,'NATION_','') AS INT)) % 7 = 0 THEN 'FAIL' ELSE 'OK' END AS run_status,
  fecha_consulta AS source_update, max(fecha_actualizacion) AS checked_at
 FROM payroll GROUP BY institucion, estado, fecha_consulta),
dict AS (
 SELECT n_name AS spanish, concat('Nation ', CAST(n_nationkey AS VARCHAR)) AS english FROM nation
 UNION ALL SELECT DISTINCT o_orderstatus, concat('Status ', o_orderstatus) FROM orders WHERE o_orderstatus <> 'P'
 UNION ALL SELECT DISTINCT cargo, replace(cargo,'CARGO_','Position ') FROM payroll
           WHERE cargo IS NOT NULL AND cargo NOT LIKE '%7'),
poll_log AS (
 SELECT event_id AS run_id,
  concat('INST_', CAST(user_id % 25 AS VARCHAR)) AS institution_name_spanish, event_type AS status_name_spanish,
  CASE WHEN event_id % 10 < 7 THEN 'OK' WHEN event_id % 10 < 9 THEN 'FAIL' ELSE 'No Update' END AS run_status,
  CAST(date_trunc('day', ts) AS TIMESTAMP) AS source_update, ts AS checked_at, ts AS start_at,
  ts + INTERVAL '90' SECOND AS end_at, CAST(value AS DOUBLE) AS time
 FROM events)
"""


# --------------------------------------------------------------------------- report workbooks
# Each payroll row becomes a data row of a report workbook: one report per
# (institution, status, update time), rows split over two sheets whose
# columns come in different orders (the second spells the id header with an
# accent). Reports of status 'P' carry no file name in their response header.

SHEET1_HEADER = ["Nombre", "Apellido", "Cedula", "Cargo", "Salario", "Gasto", "Estado", "Fecha de Inicio"]
SHEET2_HEADER = ["Fecha de Inicio", "Estado", "Gasto", "Salario", "Cargo", "Cédula", "Apellido", "Nombre"]
NO_FILE_NAME_STATUS = "P"


def _report_id() -> Column:
    return F.concat_ws("|", "institucion", "estado", F.date_format("fecha_actualizacion", "yyyyMMddHHmmss"))


def report_sheets(payroll_df: DataFrame) -> DataFrame:
    """Sheet rows ``(report_id, sheet_no, row_no, cells)`` of all reports."""
    p = payroll_df.withColumns({"report_id": _report_id(),
                                "sheet_no": (F.col("row_id") % 2 + 1).cast("int")})
    values = {
        "Nombre": F.col("nombre"), "Apellido": F.col("apellido"), "Cedula": F.col("cedula"),
        "Cargo": F.col("cargo"), "Salario": F.col("salario").cast("string"),
        "Gasto": F.col("gasto").cast("string"), "Estado": F.col("estado"),
        "Fecha de Inicio": F.date_format("fecha_de_inicio", "dd/MM/yyyy"),
    }
    cells1 = F.array(*[values[h] for h in SHEET1_HEADER])
    cells2 = F.array(*[values["Cedula" if h == "Cédula" else h] for h in SHEET2_HEADER])
    data = p.select("report_id", "sheet_no", (F.col("row_id") + 6).cast("int").alias("row_no"),
                    F.when(F.col("sheet_no") == 1, cells1).otherwise(cells2).alias("cells"))
    # Every workbook has both sheets (a sheet may hold no data rows).
    sheets = (p.groupBy("report_id").agg(F.max("fecha_actualizacion").alias("fa"), F.max("institucion").alias("inst"))
              .withColumn("sheet_no", F.explode(F.array(F.lit(1), F.lit(2)))))
    banner_text = F.concat(F.lit("Fecha de actualización: "), F.date_format("fa", "dd/MM/yyyy hh:mm:ss a"))
    null = F.lit(None).cast("string")
    top = F.array(
        F.struct(F.lit(1).alias("row_no"), F.array(F.lit("Informe de pagos"), null, null, null, null).alias("cells")),
        F.struct(F.lit(2).alias("row_no"), F.array(F.col("inst"), null, null, null, null).alias("cells")),
        F.struct(F.lit(3).alias("row_no"), F.array(null, null, null, null, banner_text).alias("cells")),
        F.struct(F.lit(4).alias("row_no"), F.array(null, null, null, null, null).alias("cells")),
        F.struct(F.lit(5).alias("row_no"),
                 F.when(F.col("sheet_no") == 1, F.array(*[F.lit(h) for h in SHEET1_HEADER]))
                  .otherwise(F.array(*[F.lit(h) for h in SHEET2_HEADER])).alias("cells")),
    )
    heads = sheets.select("report_id", "sheet_no", F.inline(top))
    return data.unionByName(heads)


def damaged_sheets(sheet_rows: DataFrame) -> DataFrame:
    """The sheets with faults by the day of the report modulo 7: 0 has no
    header in its second sheet, 1 no banner, 2 money with a thousands
    separator, 3 dates with dashes, 4 no rows at all."""
    fault = F.substring("report_id", -8, 2).cast("int") % 7
    lost = (((fault == 0) & (F.col("sheet_no") == 2) & (F.col("row_no") == 5))
            | ((fault == 1) & (F.col("row_no") == 3)) | (fault == 4))
    cells = (F.when(fault == 2, F.transform("cells", lambda c: F.regexp_replace(c, "^[0-9.]+$", "1,200.50")))
              .when(fault == 3, F.transform("cells", lambda c: F.replace(c, F.lit("/"), F.lit("-"))))
              .otherwise(F.col("cells")))
    return sheet_rows.where(~lost).withColumn("cells", F.when(F.col("row_no") > 5, cells).otherwise(F.col("cells")))


def report_meta(payroll_df: DataFrame) -> DataFrame:
    """One metadata row per report: institution, status, response header and
    data version."""
    g = payroll_df.groupBy(_report_id().alias("report_id")).agg(
        F.max("institucion").alias("institucion"), F.max("estado").alias("estado"),
        F.max("archivo").alias("archivo"), F.max("fecha_consulta").alias("data_version"))
    cd = F.when(F.col("estado") == NO_FILE_NAME_STATUS, F.lit(None).cast("string")) \
          .otherwise(F.concat(F.lit('attachment; filename="'), F.col("archivo"), F.lit('.xlsx"')))
    return g.select("report_id", "institucion", "estado", cd.alias("content_disposition"), "data_version")


# --------------------------------------------------------------------------- portal pages
# The portal index page states its data version in one line. Each test page
# gets such a line, with a time derived from its page_id, before its html.

def select_pages(pages_df: DataFrame) -> DataFrame:
    """Each page with a drop-down before its html: a placeholder, a blank
    entry, and names with tags and character references."""
    n = _s("page_id")
    drop_down = F.concat(
        F.lit("<SELECT class=\"c\" ID='cmbInst'><option>Seleccione uno</option><option> &nbsp; </option>"),
        F.lit("<OPTION value=\"1\"> MINISTERIO DE ECONOM&#205;A &amp; FINANZAS <b>"), n, F.lit("</b></OPTION>"),
        F.lit("<option>A&Ntilde;O &#x20AC; "), n, F.lit(" &amp;amp; &nada;</option></SELECT>"))
    return pages_df.select("page_id", "url", F.concat(drop_down, F.coalesce("html", F.lit(""))).alias("html"))


def portal_pages(pages_df: DataFrame) -> DataFrame:
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), (F.col("page_id") * 7).cast("int"), F.lit(0), (F.col("page_id") % 60).cast("decimal(18,6)"))
    line = F.concat(F.lit('<div id="lblFecha">Fecha de actualización de los datos:  '),
                    F.date_format(ts, "d/M/yyyy h:mm:ss a"), F.lit("</div>"))
    return pages_df.select("page_id", "url", F.concat(line, F.col("html")).alias("html"))


def index_page(payroll_df: DataFrame) -> DataFrame:
    """The portal's index page for a payroll: its newest data version, and
    drop-downs of its institutions and statuses (few names, one page)."""
    def drop_down(select_id: str, name: str) -> Column:
        names = F.array_join(F.transform(F.array_sort(F.collect_set(name)), lambda n: F.concat(
            F.lit("<option>"), n, F.lit("</option>"))), "")
        return F.concat(F.lit(f'<select id="{select_id}"><option>Seleccione uno</option>'), names, F.lit("</select>"))

    line = F.concat(F.lit("<p>Fecha de actualización de los datos:  "),
                    F.date_format(F.max("fecha_consulta"), "d/M/yyyy h:mm:ss a"), F.lit("</p>"))
    return payroll_df.agg(F.concat(line, drop_down("cmbInst", "institucion"), drop_down("cmbEstado", "estado")).alias("html")) \
        .select(F.lit(0).cast("long").alias("page_id"), F.lit("index").alias("url"), "html")
