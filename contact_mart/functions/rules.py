"""Row-wise business rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_CATEGORIZED = "NOT_CATEGORIZED"

# Outcome texts of the chat indicator table.
SOLVED_OUTCOME = "resuelve"
UNSOLVED_OUTCOMES = (
    "deriva", "crea caso", "agente deja de contestar", "short",
    "no se puede hacer", "posterga", "falla sistema",
    "recontacto", "no se puede determinar",
)
COMPLIANCE_WEIGHTS = (
    "m1_welcome_weight",
    "m2_inquiry_weight",
    "m3_empathy_weight",
    "m4_expectation_adjustment_weight",
    "m5_management_weight",
    "m6_information_provision_weight",
    "m7_service_confirmation_weight",
    "m8_farewell_weight",
)
# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WEIGHTED_CANALS = ("wsp", "voz", "chat")


def stripped(text: Column) -> Column:
    """The text without white space at its ends, of every kind; ``trim`` takes blanks alone."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def handling_time(talk: Column, held: Column, after: Column) -> Column:
    zero = F.lit(0)
    return talk + F.coalesce(held, zero) + F.coalesce(after, zero)


def zone_of_language(language: Column) -> Column:
    return F.when(language.startswith("PT"), "BR").otherwise("SSC")


def zone_of_country(country: Column) -> Column:
    return F.when(F.upper(country) == "BR", "BR").otherwise("SSC")


def origin(human_id: Column, bot_id: Column) -> Column:
    """Which side of the channel merge a row comes from."""
    return (
        F.when(human_id.isNull(), "NOT_HUMAN")
        .when(bot_id.isNull(), "HUMAN")
        .when(human_id == bot_id, "BOTH")
    )


def market(code: Column, queue_country: Column) -> Column:
    return F.coalesce(code, F.upper(queue_country), F.lit("SSC"))


def market_zone(code: Column, queue_country: Column) -> Column:
    """BR or SSC for a known market; without one, the country of the queue."""
    unknown_but_listed = code.isNull() & queue_country.isNotNull()
    return F.when(unknown_but_listed, F.upper(queue_country)).when(code == "BR", "BR").otherwise("SSC")


def canal_of(channel: Column, human: Column) -> Column:
    spoken = channel.isNull() | (channel == "voice")
    routed = (channel == "CC") & human.isin("HUMAN", "BOTH", "NOT_HUMAN")
    return (
        F.when(spoken | routed, "voz")
        .when(channel.isin("open", "whatsapp", "bot_wsp"), "wsp")
        .when(channel == "webmessaging", "chat")
        .when(F.upper(channel) == "CASES", "cases")
    )


def joined_text(*parts: Column) -> Column:
    """NULL as soon as one part is NULL."""
    return F.concat(*parts)


def true_false(flag: Column) -> Column:
    text = stripped(flag.cast("string"))
    return F.when(text == "true", 1).when(text == "false", 0)


def outcome_flag(text: Column) -> Column:
    clean = stripped(text)
    return F.when(clean == SOLVED_OUTCOME, 1).when(clean.isin(*UNSOLVED_OUTCOMES), 0)


def fcr_flag(canal: Column, ticket: Column, analysed: Column, chat: Column) -> Column:
    """First-contact resolution: tickets have a source of their own, others two in turn."""
    return F.when(canal == "cases", true_false(ticket)).otherwise(
        F.coalesce(true_false(analysed), outcome_flag(chat))
    )


def effective_time(canal: Column, time: Column, factor: Column) -> Column:
    return F.when(canal == "voz", time).otherwise(F.try_divide(time, factor))


def quality_score(weights: list[Column]) -> Column:
    total = F.lit(0.0)
    for weight in weights:
        total = total + F.coalesce(weight, F.lit(0.0))
    return total


def nps_by_text(score: Column) -> Column:
    """+100, 0 or -100 from the score text; any other text counts as neutral."""
    return (
        F.when(score.isin("9", "10"), 100)
        .when(score.isin(*[str(n) for n in range(7)]), -100)
        .when(score.isNotNull(), 0)
    )


def nps_by_number(score: Column) -> Column:
    """+100, 0 or -100 from the score as a number; anything else is NULL."""
    number = score.try_cast("int")
    return F.when(number.between(9, 10), 100).when(number.between(7, 8), 0).when(number.between(0, 6), -100)


def traceable(*ids: Column) -> Column:
    known = F.lit(False)
    for value in ids:
        known = known | value.isNotNull()
    return known


def unreliable_voice(human: Column, canal: Column, category: Column, day: Column, cutover: date) -> Column:
    """Uncategorised human voice rows strictly after the cutover lose their indicators."""
    return (human == "HUMAN") & (canal == "voz") & (category == NOT_CATEGORIZED) & (day > F.lit(cutover))


def reweighted(human: Column, canal: Column, day: Column, cutover: date) -> Column:
    """Rows among which the weight of uncategorised contacts is re-spread."""
    return (human == "HUMAN") & (
        canal.isin(*WEIGHTED_CANALS) | ((canal == "cases") & (day >= F.lit(cutover)))
    )


def tenure_label(days: Column, edges: tuple[int, ...], floor: int, unknown_below: bool) -> Column:
    """Bucket of a tenure in days: 'a 0-30', 'b 30-60', … and '>last'.

    ``floor`` is the exclusive lower bound of the first bucket. Values up to it are
    unknown ('S/I') when ``unknown_below``, else they fall into the second bucket.
    """
    unknown = F.lit("S/I")
    rule = F.when(days.isNull(), unknown)
    if unknown_below:
        rule = rule.when(days <= floor, unknown)
    lower = 0
    for letter, edge in zip("abcdefghij", edges):
        inside = days <= edge
        if lower == 0:
            inside = inside & (days > floor)
        rule = rule.when(inside, f"{letter} {lower}-{edge}")
        lower = edge
    return rule.otherwise(f"{'abcdefghij'[len(edges)]} >{edges[-1]}")
