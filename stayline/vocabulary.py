"""Values the source system and the reports use; operators take a `Vocabulary` so none is buried in code."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Vocabulary:
    unpaid: str
    held: str
    lodging: str
    tent: str
    other: str
    desk_area: str
    partner_area: str
    property_area: str
    unclassified: str
    domestic: str
    foreign: str
    segments: tuple[str, str, str, str]
    usd_spellings: tuple[str, ...] = ("DOLARES", "DÓLARES", "USD")


# The words the property-management export and its reports are written in.
PMS = Vocabulary(
    unpaid="No pagado",
    held="Reservado",
    lodging="Habitacion",
    tent="Carpa",
    other="Otros",
    desk_area="Área Reservas",
    partner_area="Socios",
    property_area="Hotel",
    unclassified="Sin clasificar",
    domestic="Perú",
    foreign="Extranjero",
    segments=("Nuevo", "Ocasional", "Fiel", "VIP"),
)

# Sales channel -> work area.
CHANNEL_SEED = [
    ("CENTRAL DE RESERVAS", PMS.desk_area),
    ("PAGINA WEB PROPIA", PMS.desk_area),
    ("PAGINA ONLINE TERCEROS (OTAS)", PMS.desk_area),
    ("POR TERCEROS", PMS.desk_area),
    ("AGENCIAS", PMS.desk_area),
    ("REDES SOCIALES", PMS.desk_area),
    ("DIRECCION DE VENTAS", PMS.desk_area),
    ("OTROS", PMS.desk_area),
    ("SOCIOS VIP", PMS.partner_area),
    ("EN HOTEL", PMS.property_area),
    ("WALKING", PMS.property_area),
    ("RESERVA EN HOTEL", PMS.property_area),
]

# Room type -> category. One type arrives under two encodings, so both are listed.
ROOM_TYPE_SEED = [
    ("FAMILIAR", PMS.lodging),
    ("SUITE", PMS.lodging),
    ("SUITE PRESIDENCIAL", PMS.lodging),
    ("CABA�A", PMS.lodging),
    ("MATRIMONIAL", PMS.lodging),
    ("TRIPLE", PMS.lodging),
    ("CABAÑA", PMS.lodging),
    ("PRESIDENCIAL", PMS.lodging),
    ("~CARPAS ARIERO", PMS.tent),
    ("~CARPAS", PMS.tent),
]

# Internal cost centres that are not open to guests, and the days the survey looks back on.
INTERNAL_PROPERTIES = (29, 999, 66)
PIVOT_PROPERTIES = (41, 60, 61, 64, 69, 71, 86)
SURVEY_DAYS = (13, 14)
