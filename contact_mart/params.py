"""Parameters of the mart: dates, allow and deny lists, month labels."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date, timedelta

# Lists below must hold exactly these texts for right results.
FACTORIES = (
    "AeC", "Almacontact", "KONECTA BR", "Konecta",
    "Estado", "Augusta", "Field Support Canales", "Field Support Brasil",
)
DENIED_QUEUES = (
    "AMC_WSP_BAG_ES",
    "NO_ USAR_ KON_BR_WSP_BAG_PT",
    "NO_USAR_KON_BR_WSP_BAG_PT",
    "AEC_WSP_BAG_PT",
    "AMC_WSP_BAG_EN",
    "KON_BR_WSP_BAG_PROACTIVE_PT",
    "AMC_WSP_BAG_PROACTIVE_ES",
    "AEC_WSP_BAG_PROACTIVE_PT",
    "AEC_WSP_BAG_SOLIX_Y_ENVIO_DOCS_PT",
    "AMC_WSP_BAG_PROACTIVE_EN",
    "AMC_CASO_EQUIPAJE_ES",
    "AMC_TRANSFER_EQUIPAJE_ES",
    "KON_BR_WSP_BAG_OUTBOUND_PT",
    "AMC_CASO_EQUIPAJE_EN",
    "AEC_PROBLEMAS_EQUIPAJE_PT",
    "KON_BR_HUB_QUIEBRE_EQUIPAJE_PT",
    "AEC_VOZ_EQUIPAJES_TRANSFER_PT",
)
EXCEPTION_GROUP = "HVC KON BR"
EXCEPTION_FORM = "SPECIAL SERVICES"
DENIED_FORMS = ("AGWS", "WEB DEVOLUCIONES", "URA", "SPECIAL SERVICES")
SYSTEM_AGENT = "LATAM AIRLINES"
DENIED_TAGS_REGEX = "monoquebrado|multiquebrado"
DENIED_TAGS_LIKE = "%project_child%"
DENIED_SUBJECT_REGEX = "TEST GOPE"
DENIED_GROUP_REGEX = "(?i)SOPORTE|SUPORTE"
# Month labels of the wide demand table: the first month is in Spanish, the rest in English.
MONTH_LABELS = ("Ene", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def first_of_previous_month(day: date) -> date:
    """Start of the rolling two-month window."""
    return ((day.replace(day=1)) - timedelta(days=1)).replace(day=1)


@dataclass(frozen=True)
class Params:
    as_of: date = field(default_factory=date.today)
    min_date: date = date(2024, 1, 1)
    cutover: date = date(2026, 1, 1)
    # Full rebuild: years of the tickets that stay. None: all from ``min_date`` on.
    ticket_years: tuple[int, ...] | None = None
    # Years that the labels of the wide demand table may name. None: from ``min_date`` to ``as_of``.
    label_years: tuple[int, ...] | None = None
    factories: tuple[str, ...] = FACTORIES
    denied_queues: tuple[str, ...] = DENIED_QUEUES
    denied_queue_like: str = "%CARGO%"
    # None: full rebuild. A date: only rows of that day and later are recomputed.
    start: date | None = None
    # Extra days by which analytics load times reach back before ``start``.
    lookback_days: int = 0
    # Incremental only: pull in older segments of conversations that cross ``start``.
    whole_conversations: bool = False
    # Count identical rows once in the category share (off: they weigh as often as they occur).
    dedupe_before_share: bool = False
    # Flag categories that come only from a bot or a chat tip and re-spread them.
    kept_bot: bool = False

    def incremental(self) -> Params:
        return replace(self, start=first_of_previous_month(self.as_of))

    @property
    def facts_from(self) -> date:
        return self.start or self.min_date

    @property
    def loads_from(self) -> date:
        return self.start - timedelta(days=self.lookback_days) if self.start else self.min_date

    @property
    def cutover_month(self) -> str:
        return self.cutover.strftime("%Y-%m")

    def month_label_rows(self) -> list[tuple[str, str]]:
        return [
            (f"{name}{year % 100:02d}", f"{year}-{number:02d}")
            for year in self.label_years or range(self.min_date.year, self.as_of.year + 1)
            for number, name in enumerate(MONTH_LABELS, start=1)
        ]
