"""Schemas of the inputs and hand-offs, and the fixed business values."""

from pyspark.sql import types as T

# They must equal the shop's own codes for results to be right.
ORDER_TYPE = "shop_order"
ORDER_STATUS = "wc-bill"
EMAIL_KEY = "_billing_email"
KIND_KEY = "tipo_prd_id"
CREDIT_NOTE = "pmi-credit-note"
KIND_MAIN = 1
KIND_OTHER = 2
FULL_FLAVOUR = "FF"
DEFAULT_BRAND = "otros"
LOYAL = "fidelizado"
AT_RISK = "en peligro"
LOST = "perdido"
LEGACY_LABELS = {"estrella": "fidelizado"}
PACK_MARKS = (("12", 12), ("20", 20), ("10", 10))  # first hit wins
BOX_PATTERN = "Box|BOX|box"
COMBO_EXEMPT = (15, 45)
CARTON_UNITS = 10
SPECIAL_CARTON_UNITS = 15
GAP_BOUNDS = ((30, "Gap Corto"), (90, "Gap Medio"), (183, "Gap Largo"))
GAP_FIRST = "Primera / Única Compra"
GAP_LONGEST = "Gap Muy Largo"
MONTH_ABBR_ES = ("ENE", "FEB", "MAR", "ABR", "MAY", "JUN",
                 "JUL", "AGO", "SEP", "OCT", "NOV", "DIC")
INDEX_COLUMNS = ("_c0", "Unnamed: 0", "")
# Tables of the shop database, by the role they play here.
SHOP_TABLES = {
    "posts": "pr_2_posts",
    "attributes": "pr_2_postmeta",
    "bills": "pr_2_pmi_bills",
    "items": "pr_2_pmi_bill_items",
    "prices": "pr_2_pmi_prices_log",
}
# End of fixed values.

RFM_COLS = ("ValorMonetario", "Frecuencia", "Recencia")
LINE_TIE = ("bill_id", "product_id", "quantity", "total_actualizado")


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_long, _int, _str = T.LongType(), T.IntegerType(), T.StringType()
_ts, _dbl = T.TimestampNTZType(), T.DoubleType()

SNAPSHOT = _schema(
    ("mail", _str), ("Multimarca", _int), ("mezcla_en_misma_compra", _int),
    ("consume_combo", _int), ("FF", _int), ("cluster_patrones_consumo", _str),
    ("rfm", _str), ("Recencia", _int), ("Frecuencia", _long), ("ValorMonetario", _dbl),
    ("fecha_segmentacion", T.DateType()), ("producto_que_consume", _str),
    ("ultima_compra", _ts), ("Contenido Ultima Compra", _str),
    ("Contenido Ante Ultima Compra", _str),
)
