"""Clustering and the composed monthly jobs."""

from pyspark.sql import functions as F

from clientela.operators import cluster as K
from clientela.operators import transitions as T
from clientela.operators.lines import in_month
from clientela.operators.rfm import iqr_filter, rfm
from clientela.plans import jobs as J
from clientela.sources import files
from clientela.sources.staging import stage_path, staged
from workload.base import (
    ACCOUNTS, ATTRIBUTED, CATALOG, LINES, RFM, SHOP, SNAPSHOTS, STATES, TIE, TIE_SQL, UNIT_CENTS, catalog,
    query, sale_lines, shop, states, weekly_snapshots)
from workload.customers import (
    _GAPCOLS, _LABELS, _MONO, _PREV, EDGES, FEATURES, KEPT, MATRIX, RANKED, _contents, _describe_sql,
    _described, _gap_sql, account_lines, rounded)

COLS = ("ValorMonetario", "Frecuencia", "Recencia")
ROUNDS = 60   # unrolled in SQL: more than any of the tables takes until nothing moves
RULES = J.Rules(method="lloyd")


def _lloyd_sql(rounds: int) -> str:
    """Scaled rows, rank seeds, unrolled rounds; `clustered` holds the final labels."""
    z = ", ".join(f'CASE WHEN s_{i} > 0 THEN ("{c}" - m_{i}) / s_{i} ELSE 0.0 END AS z{i}'
                  for i, c in enumerate(COLS))
    stats = ", ".join(f'avg("{c}") AS m_{i}, stddev_pop("{c}") AS s_{i}' for i, c in enumerate(COLS))
    ctes = [f"""scaled AS MATERIALIZED (SELECT kept.*, {z} FROM kept, (SELECT {stats} FROM kept))""",
            """placed AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r, count(*) OVER () AS n
  FROM (SELECT DISTINCT "ValorMonetario" AS v FROM scaled))""",
            """seeds AS (SELECT i, min(v) AS v FROM placed, (VALUES (0), (1), (2)) s(i)
  WHERE r = CAST(floor((2 * i + 1) / 6.0::DOUBLE * (n - 1)) AS BIGINT) GROUP BY i)""",
            """c0 AS (SELECT i, z0, z1, z2 FROM (SELECT seeds.i, scaled.*, row_number() OVER (
    PARTITION BY seeds.i ORDER BY mail) AS rn FROM seeds JOIN scaled ON "ValorMonetario" = v) WHERE rn = 1)"""]
    for t in range(rounds + 1):
        ctes.append(f"""a{t} AS MATERIALIZED (SELECT mail, arg_min(i, (dist, i)) AS i FROM (SELECT scaled.mail, c.i,
    (scaled.z0 - c.z0) ** 2 + (scaled.z1 - c.z1) ** 2 + (scaled.z2 - c.z2) ** 2 AS dist
    FROM scaled, c{t} c) GROUP BY mail)""")
        if t < rounds:
            ctes.append(f"""c{t + 1} AS MATERIALIZED (SELECT i, avg(z0) AS z0, avg(z1) AS z1, avg(z2) AS z2
  FROM scaled JOIN a{t} USING (mail) GROUP BY i)""")
    ctes.append(f"""clustered AS (SELECT scaled.*, CAST(a{rounds}.i AS INTEGER) AS rfm_cluster
  FROM scaled JOIN a{rounds} USING (mail))""")
    return ",\n".join(ctes)


LLOYD = _lloyd_sql(ROUNDS)
MEANS = """means AS (SELECT rfm_cluster, avg("ValorMonetario") AS "ValorMonetario", avg("Frecuencia") AS "Frecuencia",
  avg("Recencia") AS "Recencia" FROM clustered GROUP BY 1)"""
NAMES = """loyal AS (SELECT CASE WHEN (SELECT count(*) FROM means WHERE "ValorMonetario" = (SELECT max("ValorMonetario") FROM means)) = 1
    THEN (SELECT min(rfm_cluster) FROM means WHERE "ValorMonetario" = (SELECT max("ValorMonetario") FROM means))
    ELSE (SELECT max(rfm_cluster) FROM means) END AS i),
names AS (SELECT rfm_cluster, CASE WHEN rfm_cluster = loyal.i THEN 'fidelizado'
    WHEN row_number() OVER (PARTITION BY rfm_cluster = loyal.i ORDER BY "Recencia" DESC, rfm_cluster DESC) = 1 THEN 'perdido'
    ELSE 'en peligro' END AS rfm FROM means, loyal)"""
BASE = f"{LINES}, {RFM}, {KEPT}, {LLOYD}"


def kept(spark, d):
    return iqr_filter(staged(rfm(sale_lines(spark, d)), "rfm"))


def lloyd(spark, d):
    return K.kmeans_lloyd(K.standardize(kept(spark, d)))


@query("standardize", f"""WITH {BASE}
SELECT mail, "ValorMonetario", "Frecuencia", "Recencia", round(z0, 6) AS "ValorMonetario_z",
  round(z1, 6) AS "Frecuencia_z", round(z2, 6) AS "Recencia_z" FROM scaled""")
def standardize(spark, d):
    return rounded(K.standardize(kept(spark, d)), 6, *K.SCALED)


STARTS = 10


def _starts_sql(rounds: int) -> str:
    """The same rounds from several starts at once, and the labels of the cheapest: `best`."""
    order = "s, i"
    ctes = ["""spots AS MATERIALIZED (SELECT z0, z1, z2, min(mail) AS id FROM scaled GROUP BY ALL)""",
            f"""k0 AS MATERIALIZED (SELECT s, row_number() OVER (PARTITION BY s ORDER BY m) - 1 AS i, z0, z1, z2 FROM (
  SELECT s, z0, z1, z2, md5(id || ':' || (42 + s)) AS m FROM spots, range({STARTS}) t(s))
  QUALIFY row_number() OVER (PARTITION BY s ORDER BY m) <= 3)"""]
    for t in range(rounds + 1):
        ctes.append(f"""b{t} AS MATERIALIZED (SELECT mail, s, arg_min(i, (dist, i)) AS i, min(dist) AS dist FROM (SELECT scaled.mail, k.s, k.i,
    (scaled.z0 - k.z0) ** 2 + (scaled.z1 - k.z1) ** 2 + (scaled.z2 - k.z2) ** 2 AS dist FROM scaled, k{t} k) GROUP BY mail, s)""")
        if t < rounds:
            ctes.append(f"""k{t + 1} AS MATERIALIZED (SELECT {order}, avg(z0) AS z0, avg(z1) AS z1, avg(z2) AS z2
  FROM scaled JOIN b{t} USING (mail) GROUP BY {order})""")
    ctes.append(f"""cheapest AS (SELECT s FROM b{rounds} GROUP BY s ORDER BY sum(dist), s LIMIT 1),
numbered AS (SELECT s, i, row_number() OVER (ORDER BY z0, z1, z2) - 1 AS label FROM k{rounds} JOIN cheapest USING (s)),
best AS (SELECT mail, CAST(label AS INTEGER) AS rfm_cluster FROM b{rounds} JOIN numbered USING (s, i))""")
    return ",\n".join(ctes)


@query("kmeans", f"WITH {LINES}, {RFM}, {KEPT}, {_lloyd_sql(0)}, {_starts_sql(ROUNDS)} SELECT mail, rfm_cluster FROM best")
def kmeans(spark, d):
    return K.kmeans(K.standardize(kept(spark, d))).select("mail", K.CLUSTER)


@query("kmeans_facts", f"""WITH {BASE}
SELECT count(*) AS filas, count(DISTINCT mail) AS clientes, 3 AS grupos, true AS cercanos, true AS costo FROM scaled""")
def kmeans_facts(spark, d):
    """What holds for any starts: each row is labelled once, every cluster has rows, each row lies
    nearest to the mean of its own cluster, and the cost is not above that of the repeatable form."""
    scaled = staged(K.standardize(kept(spark, d)), "scaled")
    labelled = staged(K.kmeans(scaled), "kmeans-labels")
    found = K.cluster_means(labelled, cols=K.SCALED).withColumnRenamed(K.CLUSTER, "cluster")
    near = K.kmeans_assign(labelled, K.SCALED, found, "cerca")
    facts = near.agg(
        F.count(F.lit(1)).alias("filas"), F.count_distinct("mail").alias("clientes"),
        F.count_distinct(K.CLUSTER).cast("int").alias("grupos"),
        F.sum(F.when(F.col("cerca") == F.col(K.CLUSTER), 0).otherwise(1)).alias("_lejos"))
    costs = [_cost(x).withColumnRenamed("costo", f"_{i}") for i, x in enumerate((labelled, K.kmeans_lloyd(scaled)))]
    return facts.crossJoin(costs[0]).crossJoin(costs[1]).select(
        "filas", "clientes", "grupos", (F.col("_lejos") == 0).alias("cercanos"),
        (F.col("_0") <= F.col("_1") * 1.0001).alias("costo"))


def _cost(labelled):
    """Squared distances to the cluster means, in all."""
    spread = labelled.groupBy(K.CLUSTER).agg(*[(F.var_pop(c) * F.count(F.lit(1))).alias(c) for c in K.SCALED])
    return spread.agg(F.sum(sum(F.col(c) for c in K.SCALED)).alias("costo"))


@query("kmeans_assign", f"""WITH {LINES}, {RFM}, cents(i, c0, c1, c2) AS (
  SELECT 0, min("ValorMonetario"), min("Frecuencia"), min("Recencia") FROM rfm
  UNION ALL SELECT 1, avg("ValorMonetario"), avg("Frecuencia"), avg("Recencia") FROM rfm
  UNION ALL SELECT 2, max("ValorMonetario"), max("Frecuencia"), max("Recencia") FROM rfm)
SELECT mail, CAST(arg_min(i, (dist, i)) AS INTEGER) AS rfm_cluster FROM (
  SELECT mail, i, ("ValorMonetario" - c0) ** 2 + ("Frecuencia" - c1) ** 2 + ("Recencia" - c2) ** 2 AS dist
  FROM rfm, cents) GROUP BY mail""")
def kmeans_assign(spark, d):
    scores = rfm(sale_lines(spark, d))
    rows = [scores.agg(*[fn(c).cast("double").alias(c) for c in COLS]).withColumn("cluster", F.lit(i))
            for i, fn in enumerate((F.min, F.avg, F.max))]
    cents = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return K.kmeans_assign(scores, COLS, cents).select("mail", K.CLUSTER)


@query("kmeans_lloyd", f"WITH {BASE} SELECT mail, rfm_cluster FROM clustered")
def kmeans_lloyd(spark, d):
    return lloyd(spark, d).select("mail", K.CLUSTER)


@query("cluster_stats", f"""WITH {BASE}
SELECT rfm_cluster, CAST(min("Recencia") AS INTEGER) AS "Recencia Min", CAST(max("Recencia") AS INTEGER) AS "Recencia Max",
  round(avg("Recencia"), 6) AS "Recencia Media", min("Frecuencia") AS "Frecuencia Min", max("Frecuencia") AS "Frecuencia Max",
  round(avg("Frecuencia"), 6) AS "Frecuencia Media", min("ValorMonetario") AS "Monetario Min",
  max("ValorMonetario") AS "Monetario Max", round(avg("ValorMonetario"), 6) AS "Monetario Media"
FROM clustered GROUP BY 1""")
def cluster_stats(spark, d):
    return rounded(K.cluster_stats(lloyd(spark, d)), 6, "Recencia Media", "Frecuencia Media", "Monetario Media")


@query("cluster_means", f"""WITH {BASE}, {MEANS} SELECT rfm_cluster, round("ValorMonetario", 6) AS "ValorMonetario",
  round("Frecuencia", 6) AS "Frecuencia", round("Recencia", 6) AS "Recencia" FROM means""")
def cluster_means(spark, d):
    return rounded(K.cluster_means(lloyd(spark, d)))


@query("argmax_group", f"""WITH {BASE}, {MEANS}
SELECT arg_max(rfm_cluster, "ValorMonetario") AS mayor_monetario, arg_max(rfm_cluster, "Recencia") AS mayor_recencia FROM means""")
def argmax_group(spark, d):
    return K.argmax_group(K.cluster_means(lloyd(spark, d)))


@query("name_clusters", f"WITH {BASE}, {MEANS}, {NAMES} SELECT * FROM names")
def name_clusters(spark, d):
    return K.name_clusters(K.cluster_means(lloyd(spark, d)))


@query("name_clusters_v2", f"""WITH {BASE}, {MEANS},
tops AS (SELECT arg_max(rfm_cluster, "ValorMonetario") AS l, arg_max(rfm_cluster, "Recencia") AS p FROM means)
SELECT rfm_cluster, CASE WHEN rfm_cluster = p THEN 'perdido' WHEN rfm_cluster = l THEN 'fidelizado'
  WHEN rfm_cluster = (SELECT min(rfm_cluster) FROM means, tops WHERE rfm_cluster NOT IN (l, p)) THEN 'en peligro' END AS rfm
FROM means, tops""")
def name_clusters_v2(spark, d):
    return K.name_clusters(K.cluster_means(lloyd(spark, d)), rule="v2")


@query("label_clusters", f"WITH {BASE}, {MEANS}, {NAMES} SELECT mail, rfm FROM clustered JOIN names USING (rfm_cluster)")
def label_clusters(spark, d):
    return K.label_clusters(lloyd(spark, d)).select("mail", "rfm")


# --- composed jobs -------------------------------------------------------------------------

JOB_MONTH = "1998-03"
_SPECIAL_V1 = "red widget ECONOMY Box 20"   # the first version compares the whole text


def _month_sql(month: str, following: str, v1: bool = False) -> str:
    """Priced lines of the orders of a month, by the latest rules or those of the first version."""
    text = "titulo || ' ' || descripcion" if v1 else "COALESCE(titulo, '') || ' ' || COALESCE(descripcion, '')"
    pack, category, price = ("NULL", 'c."CATEGORÍA"', "p.precio") if v1 else (
        "1", "COALESCE(c.\"CATEGORÍA\", 'otros')", "COALESCE(p.precio, 0)")
    no_text = "WHEN td IS NULL THEN NULL" if v1 else ""
    carton = (f"CASE WHEN COALESCE(td = '{_SPECIAL_V1}', FALSE) THEN 15 WHEN tipo_prd_id = 1 THEN 10 ELSE 0 END" if v1 else
              "CASE WHEN contains(td, 'Box 20') THEN 15 WHEN tipo_prd_id = 2 THEN 1 ELSE 10 END")
    return f"""raw AS (
  SELECT i.bill_id, i.product_id, i.quantity, p.titulo, p.descripcion, CAST(k.meta_value AS INTEGER) AS tipo_prd_id,
    b.post_id, b.type, b.fecha, m.meta_value AS mail
  FROM s_items i JOIN s_bills b USING (bill_id) JOIN s_orders o ON o."ID" = b.post_id
    AND o.post_type = 'shop_order' AND o.post_status = 'wc-bill'
    AND o.post_date >= TIMESTAMP '{month}-01' AND o.post_date < TIMESTAMP '{following}-01'
  {"" if v1 else "LEFT "}JOIN s_attributes m ON m.post_id = o."ID" AND m.meta_key = '_billing_email'
  LEFT JOIN s_products p ON p.product_id = i.product_id
  LEFT JOIN s_attributes k ON k.post_id = i.product_id AND k.meta_key = 'tipo_prd_id'),
netted AS (SELECT *, CASE WHEN nt = 'pmi-credit-note' AND np = product_id AND nf > fecha THEN quantity - nq ELSE quantity END AS q
  FROM (SELECT *, {text} AS td, lead(type) OVER w AS nt, lead(product_id) OVER w AS np, lead(fecha) OVER w AS nf,
      lead(quantity) OVER w AS nq FROM raw
    WINDOW w AS (PARTITION BY post_id ORDER BY {text}, fecha, bill_id, quantity))),
prices AS (SELECT product_id, precio FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY fecha DESC, precio DESC) AS rn
  FROM s_prices) WHERE rn = 1),
month_lines AS (SELECT n.bill_id, n.product_id, CAST(q AS INTEGER) AS quantity, n.titulo, n.descripcion, tipo_prd_id, post_id, type,
    fecha, mail, td AS titulo_descripcion,
    CASE WHEN tipo_prd_id = 2 THEN 1 WHEN contains(td, '12') THEN 12 WHEN contains(td, '20') THEN 20 WHEN contains(td, '10') THEN 10 ELSE {pack} END AS "Unidad",
    CASE WHEN tipo_prd_id = 2 THEN 'Otros Productos' {no_text} WHEN regexp_matches(td, 'Box|BOX|box') THEN 'Box' ELSE 'Soft_pack' END AS "Presentacion",
    CASE WHEN (q < 10 OR q % 2 <> 0) AND q NOT IN (15, 45{"" if v1 else ", 1"}) THEN 1 ELSE 0 END AS "Combo", strftime(fecha, '%Y-%m') AS "Periodo",
    {carton} AS "Carton_unidad", CASE WHEN {carton} > 0 THEN q / CAST({carton} AS DOUBLE) ELSE 0.0 END AS "Carton_cantidad",
    COALESCE(c."MARCA", 'otros') AS "MARCA", {category} AS "CATEGORÍA",
    {price} AS precio, CAST({price} * q AS DOUBLE) AS total_actualizado
  FROM netted n LEFT JOIN catalog c ON c.titulo = n.titulo LEFT JOIN prices p ON p.product_id = n.product_id
  WHERE type <> 'pmi-credit-note' AND q {"<>" if v1 else ">"} 0)"""


MONTH_LINES = _month_sql(JOB_MONTH, "1998-04")


def month_lines(spark, d):
    return J.monthly_lines(shop(spark, d), catalog(spark, d), JOB_MONTH,
                           rules=J.Rules(special="Box 20"))


@query("monthly_lines", f"WITH {SHOP}, {CATALOG}, {MONTH_LINES} SELECT * FROM month_lines")
def monthly_lines(spark, d):
    return month_lines(spark, d)


@query("monthly_lines_v1", f"""WITH {SHOP}, {CATALOG}, {_month_sql(JOB_MONTH, "1998-04", v1=True)}
SELECT * FROM month_lines""")
def monthly_lines_v1(spark, d):
    return J.monthly_lines(shop(spark, d), catalog(spark, d), JOB_MONTH, rules=J.Rules(v1=True, special=_SPECIAL_V1))


_ACC_COLS = ("mail", "post_id", "bill_id", "product_id", "quantity", "fecha", "Periodo", "l_linenumber", "l_suppkey")
_ACC_MONTH = "2001-10"


@query("accumulate", f"""WITH {LINES}, prices AS (SELECT product_id, precio FROM (
    SELECT l_partkey AS product_id, {UNIT_CENTS} AS precio,
      row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, {UNIT_CENTS} DESC) AS rn
    FROM lineitem WHERE l_partkey IN (SELECT product_id FROM lines WHERE "Periodo" = '{_ACC_MONTH}')) WHERE rn = 1),
top AS (SELECT product_id FROM lines WHERE "Periodo" = '{_ACC_MONTH}' GROUP BY 1 ORDER BY sum(quantity) DESC, 1 LIMIT 4),
old AS (SELECT CAST(total_actualizado AS DOUBLE) / quantity AS viejo FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY fecha, {TIE_SQL}) AS rn FROM lines
  WHERE "Periodo" < '{_ACC_MONTH}' AND product_id IN (SELECT product_id FROM top)) WHERE rn = 1),
idx AS (SELECT CASE WHEN o > 0 THEN n / o ELSE 1.0 END AS indice FROM (SELECT
  (SELECT CAST(sum(precio) AS DOUBLE) FROM prices WHERE product_id IN (SELECT product_id FROM top)) AS n,
  (SELECT sum(viejo) FROM old) AS o))
SELECT {", ".join("l." + (f'"{c}"' if c == "Periodo" else c) for c in _ACC_COLS)}, round(CASE WHEN "Periodo" >= '{_ACC_MONTH}' THEN CAST(total_actualizado AS DOUBLE)
  ELSE COALESCE(CAST(p.precio AS DOUBLE), CAST(total_actualizado AS DOUBLE) / quantity * (SELECT indice FROM idx)) * quantity END, 4) AS total_actualizado
FROM lines l LEFT JOIN prices p USING (product_id) WHERE "Periodo" <= '{_ACC_MONTH}'""")
def accumulate(spark, d):
    """History up to a month at current money, plus that month."""
    lines = sale_lines(spark, d).select(*_ACC_COLS, "total_actualizado")
    now = lines.filter(in_month(F.col("fecha"), _ACC_MONTH))
    old = lines.filter(F.col("fecha") < F.lit(f"{_ACC_MONTH}-01").cast("timestamp_ntz"))
    log = shop(spark, d)["prices"].withColumn("product_id", F.col("product_id") - 1_000_000_000)
    out = J.accumulate(old, now.withColumn("total_actualizado", F.col("total_actualizado").cast("double")),
                       J.month_prices(log, now), _ACC_MONTH, tie=TIE)
    return out.select(*_ACC_COLS, F.round("total_actualizado", 4).alias("total_actualizado"))


AS_OF, SNAP_DATE = "2001-10-31", "2001-10-01"
FIRST_RULES = J.Rules(v1=True, special=_SPECIAL_V1, zero_is_multi=True, distinct_contents=False, text_style="list",
                      iqr_k=None, method="lloyd", within_label=True)


def _active_sql(as_of: str) -> str:
    return f"""lines AS (SELECT * FROM all_lines WHERE mail IN (SELECT mail FROM all_lines GROUP BY mail
  HAVING max(fecha) >= TIMESTAMP '{as_of}' - INTERVAL 365 DAY))"""


def _segments_sql(date: str, v1: bool = False) -> str:
    """Snapshot of the customers of `lines` and `attributed`, by the latest rules or those of the first version."""
    flags = FEATURES.replace('> 1 THEN 1 ELSE 0 END AS "Multimarca"', '= 1 THEN 0 ELSE 1 END AS "Multimarca"') if v1 else FEATURES
    return f"""{flags}, {RFM}, {"kept AS (SELECT * FROM rfm)" if v1 else KEPT}, {LLOYD},
{MEANS}, {NAMES}, {_MONO}, {_contents(not v1)}, {RANKED},
two AS (SELECT mail, max(CASE WHEN orden = 1 THEN contenido END) AS c1, max(CASE WHEN orden = 2 THEN contenido END) AS c2
  FROM ranked GROUP BY mail),
segments AS (SELECT c.mail, f."Multimarca", f.mezcla_en_misma_compra, f.consume_combo, f."FF", f.cluster_patrones_consumo,
  n.rfm, c."Recencia", c."Frecuencia", c."ValorMonetario", DATE '{date}' AS fecha_segmentacion, m.{"lista" if v1 else "producto_que_consume"} AS producto_que_consume,
  u.ultima_compra, t.c1 AS "Contenido Ultima Compra", t.c2 AS "Contenido Ante Ultima Compra"
FROM clustered c JOIN labelled f USING (mail) JOIN names n USING (rfm_cluster) LEFT JOIN monos m USING (mail)
JOIN (SELECT mail, max(fecha) AS ultima_compra FROM lines GROUP BY mail) u USING (mail) LEFT JOIN two t USING (mail))"""


_BEFORE = f"""{ACCOUNTS.replace("lines AS", "all_lines AS", 1)}, {_active_sql(AS_OF)}, {ATTRIBUTED}"""
SEGMENTS = f"{_BEFORE}, {_segments_sql(SNAP_DATE)}"


#: What the segmentation reads of a line.
SEGMENT_LINES = ("mail", "bill_id", "titulo", "MARCA", "CATEGORÍA", "tipo_prd_id", "fecha", "total_actualizado", "Periodo", "Combo", "Presentacion")


def stored_history(spark, d):
    """The history is a stored table, as it is between two monthly runs."""
    return staged(account_lines(spark, d).select(*SEGMENT_LINES), "history")


def segments(spark, d):
    return J.segment_customers(stored_history(spark, d), AS_OF, SNAP_DATE, RULES)


@query("segment_customers", f"WITH {SEGMENTS} SELECT * FROM segments")
def segment_customers(spark, d):
    return segments(spark, d)


@query("segment_customers_v1", f"WITH {_BEFORE}, {_segments_sql(SNAP_DATE, v1=True)} SELECT * FROM segments")
def segment_customers_v1(spark, d):
    """By the rules of the first version: no main product counts as several brands, outliers stay,
    repeated titles too, single brands in the list form."""
    return J.segment_customers(stored_history(spark, d), AS_OF, SNAP_DATE, FIRST_RULES)


_FACTS = ("mail", "Multimarca", "mezcla_en_misma_compra", "consume_combo", "FF", "cluster_patrones_consumo", "Recencia",
          "Frecuencia", "ValorMonetario", "fecha_segmentacion", "producto_que_consume", "ultima_compra",
          "Contenido Ultima Compra", "Contenido Ante Ultima Compra")


@query("segment_customers_default", f"WITH {SEGMENTS} SELECT {', '.join(chr(34) + c + chr(34) for c in _FACTS)}, true AS nombrado FROM segments")
def segment_customers_default(spark, d):
    """With the job's own clustering, whose labels depend on its starts: all else, and that every
    customer has a label."""
    done = J.segment_customers(stored_history(spark, d), AS_OF, SNAP_DATE)
    return done.select(*_FACTS, F.col("rfm").isNotNull().alias("nombrado"))


def old_snapshots(spark, d):
    """Earlier weekly snapshots, under a legacy label and with dates kept as text."""
    df = weekly_snapshots(spark, d).filter("fecha_segmentacion < '2024-01-15'")
    return df.select("mail", F.when(F.col("rfm") == "purchase", "estrella").otherwise(F.col("rfm")).alias("rfm"),
                     "ultima_compra", F.col("fecha_segmentacion").cast("string").alias("fecha_segmentacion"))


def history(spark, d):
    now = weekly_snapshots(spark, d).filter("fecha_segmentacion >= '2024-01-15'")
    return J.segmentation_history(now, old_snapshots(spark, d))


HISTORY = f"""{SNAPSHOTS.replace("snaps AS", "weeks AS", 1)}, snaps AS (SELECT mail, fecha_segmentacion, ultima_compra,
  CASE WHEN fecha_segmentacion < DATE '2024-01-15' AND rfm = 'purchase' THEN 'fidelizado' ELSE rfm END AS rfm FROM weeks),
{_gap_sql('mail')}"""


@query("segmentation_history", f"WITH {HISTORY} SELECT {_GAPCOLS} FROM gaps")
def segmentation_history(spark, d):
    return history(spark, d)


@query("segmentation_history_within_label", f"WITH {HISTORY.replace('PARTITION BY mail', 'PARTITION BY mail, rfm')} SELECT {_GAPCOLS} FROM gaps")
def segmentation_history_within_label(spark, d):
    now = weekly_snapshots(spark, d).filter("fecha_segmentacion >= '2024-01-15'")
    return J.segmentation_history(now, old_snapshots(spark, d), J.Rules(within_label=True))


def _run_sql(v1: bool = False) -> str:
    """Two months in a row: lines of both, the first month's history at the second's money without
    the months that the second replaces, a snapshot after each month, and the second's with its gaps."""
    def snapshot(source: str, as_of: str, date: str) -> str:
        return (f"(WITH all_lines AS (SELECT * FROM {source}), {_active_sql(as_of)}, attributed AS (SELECT * FROM lines), "
                f"{_segments_sql(date, v1)} SELECT * FROM segments)")

    return f"""WITH {SHOP}, {CATALOG},
march AS MATERIALIZED (WITH {_month_sql("1998-03", "1998-04", v1)} SELECT * FROM month_lines),
april AS MATERIALIZED (WITH {_month_sql("1998-04", "1998-05", v1)} SELECT * FROM month_lines),
now_prices AS (SELECT product_id, CAST(precio AS DOUBLE) AS ahora FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY fecha DESC, precio DESC) AS rn FROM s_prices
  WHERE product_id IN (SELECT product_id FROM april)) WHERE rn = 1),
top AS (SELECT product_id FROM april GROUP BY 1 ORDER BY sum(quantity) DESC, 1 LIMIT 4),
firsts_of_top AS (SELECT total_actualizado / quantity AS viejo FROM march WHERE product_id IN (SELECT product_id FROM top)
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY fecha, bill_id, product_id, quantity, total_actualizado) = 1),
idx AS (SELECT CASE WHEN o > 0 THEN COALESCE(n, 0) / o ELSE 1.0 END AS indice FROM (SELECT
  (SELECT sum(ahora) FROM now_prices WHERE product_id IN (SELECT product_id FROM top)) AS n, (SELECT sum(viejo) FROM firsts_of_top) AS o)),
history AS MATERIALIZED (
  SELECT * EXCLUDE (precio) FROM april
  UNION ALL BY NAME
  SELECT march.* EXCLUDE (precio) REPLACE (COALESCE(ahora, total_actualizado / quantity * (SELECT indice FROM idx)) * quantity AS total_actualizado)
  FROM march LEFT JOIN now_prices USING (product_id) WHERE "Periodo" <> '1998-04'),
first_snap AS MATERIALIZED {snapshot("march", "1998-03-31", "1998-03-01")},
second_snap AS MATERIALIZED {snapshot("history", "1998-04-30", "1998-04-01")},
snaps AS (SELECT * FROM first_snap UNION ALL SELECT * FROM second_snap),
{_gap_sql("mail, rfm" if v1 else "mail")}
SELECT * EXCLUDE (g) REPLACE (round("ValorMonetario", 4) AS "ValorMonetario") FROM gaps WHERE fecha_segmentacion = DATE '1998-04-01'"""


def _published_run(spark, d, rules):
    """Two monthly runs in a row over the shop's tables, and the published table, the last month's
    snapshot, read back."""
    store = stage_path(spark, "store")
    tables, titles = shop(spark, d), catalog(spark, d)
    for turn, day in enumerate(("1998-04-01", "1998-05-01")):
        paths = J.run_month(tables, titles, day, store, first=turn == 0, rules=rules)
    schema = spark.read.parquet(paths["snapshots"]).schema
    return rounded(files.read_csv_snapshot(spark, paths["latest"], schema), 4, "ValorMonetario")


@query("run_month", _run_sql())
def run_month(spark, d):
    return _published_run(spark, d, J.Rules(special="Box 20", method="lloyd"))


@query("run_month_v1", _run_sql(v1=True))
def run_month_v1(spark, d):
    """The whole chain by the rules of the first version."""
    return _published_run(spark, d, FIRST_RULES)


NOW = "now AS (SELECT * FROM gaps WHERE fecha_segmentacion = DATE '2024-01-15')"


@query("gap_report", f"""WITH {HISTORY}, {NOW}
SELECT d.*, s.* EXCLUDE (rfm, columna) FROM (SELECT rfm, segmento_gap, count(DISTINCT mail) AS cantidad_de_clientes,
  count(*) AS filas FROM now GROUP BY 1, 2) d JOIN ({_describe_sql('gap_entre_compras', 'g', 'now', 'rfm')}) s ON s.rfm = d.rfm""")
def gap_report(spark, d):
    dist, summary = J.gap_report(staged(history(spark, d), "history"), "2024-01-15")
    return dist.join(_described(summary), "rfm")


@query("transition_report", f"""WITH {STATES}, {_PREV}, {EDGES}, matrix AS ({MATRIX}),
nodes AS (SELECT rfm AS rfm_anterior, count(*) AS total FROM states GROUP BY 1)
SELECT edges.rfm_anterior, edges.rfm, edges.cantidad, nodes.total, matrix.* EXCLUDE (rfm_anterior)
FROM edges JOIN nodes USING (rfm_anterior) JOIN matrix USING (rfm_anterior)""")
def transition_report(spark, d):
    snap = states(spark, d)
    report = J.transition_report(snap, tie=("event_id",))
    matrix = rounded(T.transition_matrix(report["edges"]))
    nodes = report["nodes"].toDF("rfm_anterior", "total")
    return report["edges"].join(nodes, "rfm_anterior").join(matrix, "rfm_anterior")
