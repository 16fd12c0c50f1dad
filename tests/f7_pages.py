"""Hand-made listing pages (FIXTURES F7): one good page and broken variants per site."""

import json

_OLX_STATE = {
    "ad": {
        "ad": {
            "params": [],
            "price": {"displayValue": "450 000 zł"},
            "location": {"districtName": "Mokotów", "cityName": "Warszawa", "regionNormalizedName": "mazowieckie"},
        }
    }
}


def _olx_script(state) -> str:
    literal = json.dumps(json.dumps(state))
    return "\n".join(
        [
            "",
            "        window.__INIT_CONFIG__ = {};",
            "        window.__LANG__ = 'pl';",
            "        window.__TOKEN__ = 'x';",
            f"        window.__PRERENDERED_STATE__= {literal};",
            "        window.__OTHER__ = 1;",
        ]
    )


OLX_PAGE = f"""<!DOCTYPE html><html lang="pl"><head>
<title>Mieszkanie 52,5 m² &amp; balkon</title>
<link href="https://www.olx.pl/d/oferta/mieszkanie-CID3-ID1.html" rel="canonical">
<meta name="description" content="Słoneczne mieszkanie
przy parku">
<script id="olx-init-config">{_olx_script(_OLX_STATE)}</script>
</head><body>
<span data-cy="ad-posted-at">12 stycznia 2024</span>
<ul class="css-sfcl1s"><li><p>Prywatne</p></li><li><p>Cena za m²: 12345.67 zł/m²</p></li>
<li><p>Rynek: Pierwotny</p></li><li><p>Poziom: Parter</p></li><li><p>Rodzaj zabudowy: Blok</p></li>
<li><p>Powierzchnia: 52,5 m²</p></li><li><p>Liczba pokoi: 2 pokoje</p></li></ul>
<div data-cy="ad_description"><div>Pierwszy akapit opisu.<br>Drugi akapit.</div></div>
<div class="swiper-zoom-container"><img src="https://img.example/1.jpg"></div>
<div class="swiper-zoom-container"><img src="https://img.example/2.jpg"></div>
<div data-cy="ad-footer-bar-section"><span>ID: </span><span>884512</span></div>
</body></html>"""

OLX_PAGE_TODAY = OLX_PAGE.replace("12 stycznia 2024", "Dzisiaj o 12:00")

# Broken: no state script, no detail list, no footer.
OLX_BROKEN = """<html><head><title></title></head><body>
<span data-cy="ad-posted-at">kiedyś</span><p>tylko tekst</p></body></html>"""

_NEXT = {
    "props": {
        "pageProps": {
            "ad": {
                "id": 65432,
                "target": {"City": "Kraków", "Province": "malopolskie"},
                "location": {"address": {"district": {"name": "Podgórze"}}},
                "createdAt": "2024-01-21T10:00:00+01:00",
                "modifiedAt": "2024-02-01T23:30:00Z",
                "images": [
                    {"small": "https://img.example/s1.jpg", "medium": "https://img.example/m1.jpg"},
                    {"small": "https://img.example/s2.jpg", "medium": "https://img.example/m2.jpg"},
                ],
            }
        }
    }
}


def _otodom(next_data, cells: dict) -> str:
    cell_html = "".join(f'<div data-testid="{k}">{v}</div>' for k, v in cells.items())
    script = f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(next_data)}</script>' if next_data else ""
    return f"""<html><head><title>Mieszkanie, Kraków</title>
<link rel="canonical" href="https://www.otodom.pl/pl/oferta/mieszkanie-ID4abc">
<meta content="Opis skrócony" name="description">{script}</head><body>
<strong aria-label="Cena">799 000 zł</strong><div aria-label="Cena za metr kwadratowy">15 215 zł/m²</div>
<a aria-label="Adres" href="#map">Kraków, Podgórze</a>
<div data-cy="adPageAdDescription"><p>Pierwszy akapit.</p><p>Drugi akapit.</p></div>
{cell_html}</body></html>"""


OTODOM_CELLS = {
    "table-value-area": "52,5 m²",
    "table-value-rooms_num": "3",
    "table-value-floor": "parter/4",
    "table-value-rent": "650 zł",
    "table-value-market": "pierwotny",
    "table-value-advertiser_type": "prywatny",
    "table-value-lift": "tak",
    "table-value-media_types": "internet, telefon",
    "table-value-building_material": "cegła",
}

OTODOM_PAGE = _otodom(_NEXT, OTODOM_CELLS)

_NO_DISTRICT = json.loads(json.dumps(_NEXT))
del _NO_DISTRICT["props"]["pageProps"]["ad"]["location"]["address"]["district"]
OTODOM_NO_DISTRICT = _otodom(_NO_DISTRICT, dict(OTODOM_CELLS, **{"table-value-rent": ""}))

OTODOM_BROKEN = _otodom(None, {})
