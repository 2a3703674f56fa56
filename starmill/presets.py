"""Ready configuration for the public state-level incidence files (one column per month)."""

from __future__ import annotations

from starmill.config import Category, StarConfig

# They must read exactly like this for results to be right.

MONTHS = (
    "Enero",
    "Febrero",
    "Marzo",
    "Abril",
    "Mayo",
    "Junio",
    "Julio",
    "Agosto",
    "Septiembre",
    "Octubre",
    "Noviembre",
    "Diciembre",
)

INTENTIONAL = "Violencia letal intencional"
UNINTENTIONAL = "Violencia letal no intencional"
NOT_LETHAL = "Violencia no letal"

CATEGORIES = {
    "Feminicidio": Category(INTENTIONAL, True),
    "Homicidio doloso": Category(INTENTIONAL, True),
    "Homicidio culposo": Category(UNINTENTIONAL, True),
    "Lesiones dolosas": Category(NOT_LETHAL, False),
    "Lesiones culposas": Category(NOT_LETHAL, False),
    "Trata de personas": Category(NOT_LETHAL, False),
    "Violencia familiar": Category(NOT_LETHAL, False),
    "Violencia de género en todas sus modalidades distinta a la violencia familiar": Category(NOT_LETHAL, False),
    "Acoso sexual": Category(NOT_LETHAL, False),
    "Hostigamiento sexual": Category(NOT_LETHAL, False),
    "Abuso sexual": Category(NOT_LETHAL, False),
    "Violación simple": Category(NOT_LETHAL, False),
    "Violación equiparada": Category(NOT_LETHAL, False),
}

REGIONS = {
    "Aguascalientes": "Centro",
    "Baja California": "Norte",
    "Baja California Sur": "Norte",
    "Campeche": "Sur",
    "Coahuila de Zaragoza": "Norte",
    "Colima": "Centro",
    "Chiapas": "Sur",
    "Chihuahua": "Norte",
    "Ciudad de México": "CDMX",
    "Durango": "Norte",
    "Guanajuato": "Centro",
    "Guerrero": "Sur",
    "Hidalgo": "Centro",
    "Jalisco": "Centro",
    "México": "Centro",
    "Michoacán de Ocampo": "Centro",
    "Morelos": "Centro",
    "Nayarit": "Centro",
    "Nuevo León": "Norte",
    "Oaxaca": "Sur",
    "Puebla": "Centro",
    "Querétaro": "Centro",
    "Quintana Roo": "Sur",
    "San Luis Potosí": "Centro",
    "Sinaloa": "Norte",
    "Sonora": "Norte",
    "Tabasco": "Sur",
    "Tamaulipas": "Norte",
    "Tlaxcala": "Centro",
    "Veracruz de Ignacio de la Llave": "Sur",
    "Yucatán": "Sur",
    "Zacatecas": "Centro",
}

FLAGGED_YEARS = frozenset({2020, 2021})

SOURCE_LABEL = "SESNSP - Incidencia delictiva estatal"

SOURCE_COLUMNS = {
    "year": "Año",
    "entity_key": "Clave_Ent",
    "entity_name": "Entidad",
    "good": "Bien jurídico afectado",
    "kind": "Tipo de delito",
    "leaf": "Subtipo de delito",
    "detail": ("Modalidad",),
    "months": MONTHS,
}

HEADLINE_LEAF = "Feminicidio"

# End of the fixed values.

STATE_INCIDENCE = StarConfig(
    **SOURCE_COLUMNS,
    categories=CATEGORIES,
    regions=REGIONS,
    flagged_years=FLAGGED_YEARS,
    source_label=SOURCE_LABEL,
)
