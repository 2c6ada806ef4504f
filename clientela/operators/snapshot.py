"""The monthly segmentation snapshot."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientela import contracts as C
from clientela.operators.ordered import joined_text
from clientela.operators.relational import lookup_join
from clientela.sources.staging import staged

LAST = "Contenido Ultima Compra"
BEFORE_LAST = "Contenido Ante Ultima Compra"


def period_contents(lines: DataFrame, distinct: bool = True, only=None) -> DataFrame:
    """Titles bought per customer and month in purchase order, ', '-joined; titles of one moment
    alphabetically. The later rule keeps each title once, the earlier one keeps repeats."""
    kept = lines.filter(F.col("mail").isNotNull() & F.col("Periodo").isNotNull())
    return joined_text(kept, ["mail", "Periodo"], "titulo", "fecha", "contenido", distinct, only=only)


def latest_months(rows: DataFrame, n: int) -> DataFrame:
    """The n latest months of each customer, numbered from the latest."""
    latest = Window.partitionBy("mail").orderBy(F.col("Periodo").desc())
    return rows.withColumn("orden", F.row_number().over(latest)).filter(F.col("orden") <= n)


def ranked_contents(lines: DataFrame, n: int, distinct: bool = True,
                    customers: DataFrame | None = None) -> DataFrame:
    """Contents of the n latest months of each customer, numbered from the latest. Months are
    ranked first, few to a customer, so no other month's text is built, nor any for others than
    the given customers."""
    def wanted(merged: DataFrame) -> DataFrame:
        months = merged.select("mail", "Periodo").distinct()
        if customers is not None:
            months = months.join(customers.select("mail"), "mail", "left_semi")
        return latest_months(months, n).drop("orden")

    return latest_months(period_contents(lines, distinct, wanted), n)


def nth_last_contents(lines: DataFrame, n: int, distinct: bool = True) -> DataFrame:
    """Contents of the n-th last purchase month (1 = last); customers without it are absent."""
    return ranked_contents(lines, n, distinct).filter(F.col("orden") == n).select("mail", "contenido")


def last_two_contents(lines: DataFrame, distinct: bool = True, customers: DataFrame | None = None) -> DataFrame:
    """Last and second-last contents side by side, from one ranking."""
    ranked = ranked_contents(lines, 2, distinct, customers)
    pick = lambda n: F.max(F.when(F.col("orden") == n, F.col("contenido")))
    return ranked.groupBy("mail").agg(pick(1).alias(LAST), pick(2).alias(BEFORE_LAST))


def products_of_monobrand(lines: DataFrame, features: DataFrame, style: str = "joined") -> DataFrame:
    """Different main-product titles of each single-brand customer, in first-purchase order.
    `style="list"` gives the bracketed form. Customers are picked after the lines have been
    merged and before texts are built."""
    single = features.filter(F.col("Multimarca") == 0).select("mail")
    main = lines.filter((F.col("tipo_prd_id") == C.KIND_MAIN) & F.col("mail").isNotNull())
    return joined_text(main, ["mail"], "titulo", "fecha", "producto_que_consume", style=style, only=lambda _: single)


def segment_join(features: DataFrame, rfm: DataFrame) -> DataFrame:
    """Customers that have both analyses; outliers drop out here."""
    return features.join(rfm, "mail", "inner")


def first_titles(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """One line for each title, month and kind of the given customers, its first. Texts without repeats
    are the same from these as from all lines. Lines are merged before customers are picked."""
    merged = lines.filter(F.col("mail").isNotNull() & F.col("titulo").isNotNull()).groupBy(
        "mail", "Periodo", "tipo_prd_id", "titulo").agg(F.min("fecha").alias("fecha"))
    return merged.join(customers.select("mail"), "mail", "left_semi")


def build_snapshot(segmented: DataFrame, lines: DataFrame, date, distinct: bool = True,
                   style: str = "joined") -> DataFrame:
    """Snapshot rows dated `date`. `segmented` holds pattern, label, RFM and ultima_compra. The lines are
    read once for all texts without repeats: what those need of them is stored."""
    titles = staged(first_titles(lines, segmented), "titles")
    out = segmented.withColumn("fecha_segmentacion", F.lit(date).cast("date"))
    out = lookup_join(out, products_of_monobrand(titles, segmented, style), "mail")
    out = lookup_join(out, last_two_contents(titles if distinct else lines, distinct, segmented), "mail")
    return out.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                        for f in C.SNAPSHOT.fields])
