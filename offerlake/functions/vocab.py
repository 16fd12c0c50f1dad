"""Fixed vocabulary of the listings pipeline.

FIXED VALUES: every literal below must equal the source sites' wording for
results to be right (null tokens, Polish labels, value translations, month
names).  They are kept together, in natural order, and are not derived.
"""

from __future__ import annotations

# --- FIXED VALUES: placeholder strings that mean "no value" (whole value, case-sensitive)
NULL_TOKENS = ("", "BRAK INFORMACJI", "MISSING", "brak informacji", "missing", "None")

# --- FIXED VALUES: floor labels rewritten before the integer cast (both sites)
FLOOR_LABELS = {"Parter": "0", "Suterena": "-1", "Powyżej 10": "11"}

# --- FIXED VALUES: words that mark a private seller, per site
PRIVATE_OWNER_WORD = {"otodom": "prywatny", "olx": "Prywatne"}

# --- FIXED VALUES: secondary-market word (otodom), lift "yes" word, "today" word, currency suffix
SECONDARY_MARKET_WORD = "wtórny"
LIFT_YES_WORD = "tak"
TODAY_WORD = "Dzisiaj"
CURRENCY_SUFFIX = " zł"

# --- FIXED VALUES: containment flags, source column -> {flag: needle} (otodom)
CONTAINMENT_FLAGS = {
    "media_types": {
        "has_tv": "telewizja kablowa",
        "has_internet": "internet",
        "has_phone_line": "telefon",
    },
    "equipment": {
        "is_furnished": "meble",
        "has_dishwasher": "zmywarka",
        "has_fridge": "lodówka",
        "has_oven": "piekarnik",
        "has_stove": "kuchenka",
        "has_washing_machine": "pralka",
    },
    "outdoor": {
        "has_garden": "ogródek",
        "has_balcony": "balkon",
        "has_porch": "taras",
    },
    "security": {
        "gated_community": "teren zamknięty",
        "guarded_building": "ochrona",
        "has_cctv": "monitoring",
    },
}

# --- FIXED VALUES: whole-value translations, otodom
OTODOM_VALUE_MAPS = {
    "windows_type": {
        "drewniane": "wood",
        "plastikowe": "pvc",
        "aluminiowe": "aluminium",
    },
    "building_material": {
        "beton": "concrete",
        "cegła": "brick",
        "silikat": "silicate",
        "żelbet": "reinforced_concrete",
        "wielka płyta": "prefabricated",
        "pustak": "honeycomb",
        "inne": "other",
    },
    "heating_type": {
        "elektryczne": "electricity",
        "gazowe": "gas",
        "miejskie": "municipal",
        "kotłownia": "boiler_room",
        "inne": "other",
    },
    "ownership_type": {
        "użytkowanie wieczyste / dzierżawa": "usufruct",
        "spółdzielcze wł. prawo do lokalu": "co_op",
        "pełna własność": "full_ownership",
        "udział": "share",
        "inne": "other",
    },
    "construction_status": {
        "do remontu": "for_renovation",
        "do wykończenia": "unfinished",
        "do zamieszkania": "ready",
        "inne": "other",
    },
    "building_type": {
        "blok": "block",
        "szeregowiec": "row_housing",
        "apartamentowiec": "apartment_building",
        "dom wolnostojący": "house",
        "kamienica": "tenement",
        "inne": "other",
    },
}

# --- FIXED VALUES: whole-value translations, OLX
OLX_VALUE_MAPS = {
    "building_type": {
        "Loft": "loft",
        "Blok": "block",
        "Szeregowiec": "row_housing",
        "Apartamentowiec": "apartment_building",
        "Dom wolnostojący": "house",
        "Kamienica": "tenement",
        "Pozostałe": "other",
    },
}

# --- FIXED VALUES: otodom source columns consumed by the flags and dropped afterwards
OTODOM_CONSUMED_COLUMNS = ("media_types", "lift", "equipment", "market", "outdoor", "parking", "security")

# --- FIXED VALUES: Polish month names in the genitive, January to December
POLISH_MONTHS = (
    "stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca",
    "lipca", "sierpnia", "września", "października", "listopada", "grudnia",
)

# --- FIXED VALUES: OLX detail-list labels and offer-type words
OLX_OFFER_TYPES = ("Prywatne", "Firmowe")
OLX_PRICE_PER_MSQ_MARK = "zł/m"
OLX_PRIMARY_MARKET_WORD = "Pierwotny"
OLX_FLOOR_LABEL = "Poziom"
OLX_BUILDING_TYPE_LABEL = "Rodzaj zabudowy"
OLX_SIZE_LABEL = "Powierzchnia"
OLX_ROOMS_LABEL = "Liczba pokoi"

# --- FIXED VALUES: otodom detail cells, bronze column -> data-testid of the cell
OTODOM_DETAIL_CELLS = {
    "size": "table-value-area",
    "n_rooms": "table-value-rooms_num",
    "construction_status": "table-value-construction_status",
    "ownership_type": "table-value-building_ownership",
    "floor": "table-value-floor",
    "rent": "table-value-rent",
    "outdoor": "table-value-outdoor",
    "parking": "table-value-car",
    "heating_type": "table-value-heating",
    "market": "table-value-market",
    "offer_type": "table-value-advertiser_type",
    "year_built": "table-value-build_year",
    "building_type": "table-value-building_type",
    "windows_type": "table-value-windows_type",
    "lift": "table-value-lift",
    "media_types": "table-value-media_types",
    "security": "table-value-security_types",
    "equipment": "table-value-equipment_types",
    "building_material": "table-value-building_material",
}

# --- FIXED VALUES: otodom aria labels of price, price per m2 and address
OTODOM_PRICE_LABEL = "Cena"
OTODOM_PRICE_PER_MSQ_LABEL = "Cena za metr kwadratowy"
OTODOM_ADDRESS_LABEL = "Adres"

# --- FIXED VALUES: model defaults
NO_MODEL_PREDICTION = -2137.0
SEARCH_SEED = 2137
MISSING_CATEGORY = "MISSING"
