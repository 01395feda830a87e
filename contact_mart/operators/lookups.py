"""Fixed lookup tables as small frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contact_mart.functions.rules import NOT_CATEGORIZED

# Raw category -> reported category. Anything else is NOT_CATEGORIZED.
CATEGORIES = {
    "CAMBIO_VOLUNTARIO": (
        "CAMBIO_VOLUNTARIO", "CORRECCION_NOMBRE", "ENDOSO", "SPLIT", "CAMBIO_VOLUNTARIO_ERROR", "CAMBIO_RUTA",
    ),
    "INFORMACION_DE_VIAJE": ("INFORMACION_DE_VIAJE", "INFORMACION_DE_FRANQUICIA"),
    "VENTAS": ("VENTAS", "PROBLEMAS_COMPRA_WEB", "COMPROBANTE_COMPRA"),
    "VENTAS_ANCILLARIES": ("VENTAS_ANCILLARIES", "VENTAS y VENTAS_ANCILLARIES", "ASIGNACION_DE_ASIENTOS"),
    "SERVICIOS_ESPECIALES": (
        "SERVICIOS_ESPECIALES", "MASCOTAS", "MENORES_NO_ACOMPANADOS", "VENTAS y SERVICIOS_ESPECIALES",
    ),
    "RECLAMOS": ("RECLAMOS", "RECLAMOS_EQUIPAJE", "ESTADO_CASO", "RECLAMO_DEVOLUCIONES"),
    "DEVOLUCIONES": ("DEVOLUCIONES", "SOLICITUD_DEVOLUCIONES"),
    "CAMBIO_INVOLUNTARIO": ("CAMBIO_INVOLUNTARIO", "Cambios Involuntarios"),
    "CANJE": ("CANJE", "UPG"),
    "OTROS_FFP": ("OTROS_FFP", "OUTROS_FFP", "ACTUALIZAR_PERFIL_CUENTA", "FFP", "ACREDITACION"),
    "CHECK_IN": ("CHECK_IN",),
    "EXCEPCIONES": ("EXCEPCIONES",),
    "LOGIN": ("LOGIN",),
    "TRAVEL_VOUCHER": ("TRAVEL_VOUCHER",),
    "OTROS": (
        "SIN INTENT", "SIN_CONTEXTO", "SILENCIO", "SILENCE", "DEFAULT", "LATAM_WALLET", "SILENCIO_AGENTE", "None",
    ),
}

# Country code -> market texts. The first listed country wins, so the
# text PT belongs to BR. Anything else is OT.
COUNTRIES = {
    "CL": ("CL", "CHILE"),
    "BR": ("BR", "BRASIL", "PT-BR", "PT", "PORTUGUÊS (BRASIL)"),
    "AR": ("AR", "ARGENTINA"),
    "PE": ("PE", "PERU"),
    "CO": ("CO", "COLOMBIA"),
    "UY": ("UY", "URUGUAY"),
    "PY": ("PY", "PARAGUAY"),
    "EC": ("EC", "ECUADOR"),
    "MX": ("MX", "MEXICO"),
    "US": ("US", "USA"),
    "GB": ("UK", "REINO UNIDO", "GRAN BRETAÑA"),
    "FR": ("FR", "FRANCIA"),
    "DE": ("DE", "ALEMANIA"),
    "IT": ("IT", "ITALIA"),
    "ES": ("ES", "ESPAÑA"),
    "PT": ("PT", "PORTUGAL"),
    "CH": ("CH", "SUIZA"),
    "BE": ("BE", "BELGICA"),
    "AT": ("AT", "AUSTRIA"),
    "AU": ("AU", "AUSTRALIA"),
    "NZ": ("NZ", "NUEVA ZELANDA"),
    "CA": ("CA", "CANADA"),
    "ZA": ("ZA", "SUDAFRICA", "ÁFRICA"),
    "DK": ("DK", "DINAMARCA"),
    "SE": ("SE", "SUECIA"),
    "NO": ("NO", "NORUEGA"),
    "IE": ("IE", "IRLANDA"),
    "IL": ("IL", "ISRAEL"),
    "CB": ("CARIBE",),
    "EU": ("EU", "EUROPA"),
    "AS": ("ASIA",),
    "OT": ("CUALQUIER OTRO MERCADO", "OTHERS"),
}

# Channel of the daily demand table -> (canal, is_human).
DEMAND_CHANNELS = {
    "Calls": ("voz", "HUMAN"),
    "WhatsApp Agent": ("wsp", "HUMAN"),
    "Chat Web": ("chat", "HUMAN"),
    "Cases": ("cases", "HUMAN"),
    "Social Media": ("rrss", "HUMAN"),
    "Voice Bot": ("voz", "NOT_HUMAN"),
    "WhatsApp Bot": ("wsp", "NOT_HUMAN"),
}


def lookup_frame(spark: SparkSession, columns: list[str], rows: list[tuple[str, ...]]) -> DataFrame:
    """Literal rows as a local relation, whose exact size the planner knows."""
    def literal(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    tuples = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {tuples} AS t({', '.join(columns)})")


def first_owner(groups: dict[str, tuple[str, ...]]) -> list[tuple[str, str]]:
    """(text, group) pairs; a text listed twice belongs to the first group."""
    owner: dict[str, str] = {}
    for group, texts in groups.items():
        for text in texts:
            owner.setdefault(text, group)
    return list(owner.items())


def map_column(
    df: DataFrame, column: str, name: str, pairs: list[tuple[str, str]], default: str | None
) -> DataFrame:
    """Add ``name``: the mapped text of ``column``, else ``default``."""
    table = lookup_frame(df.sparkSession, ["_from", "_to"], pairs)
    joined = df.join(table, F.col(column) == F.col("_from"), "left")
    mapped: Column = F.col("_to") if default is None else F.coalesce("_to", F.lit(default))
    return joined.withColumn(name, mapped).drop("_from", "_to")


def homologate(df: DataFrame, column: str = "category", name: str | None = None) -> DataFrame:
    return map_column(df, column, name or column, first_owner(CATEGORIES), NOT_CATEGORIZED)


def with_country(df: DataFrame, column: str = "market_code", name: str = "country_code") -> DataFrame:
    return map_column(df, column, name, first_owner(COUNTRIES), "OT")
