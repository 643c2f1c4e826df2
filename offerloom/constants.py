"""Settings with a meaning for results; all can be overridden."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -------------------------------------------------------------------------------
BAD_BRANDS = ("dr", "my")
BAD_BRAND_PARTS = ("brn ", "markasiz", "erkek", "kadin", " adet")
BAD_COLOR_PARTS = ("nocolor", "no color", "cok renkli", "renkli")
BAD_SUBCAT_PARTS = ("indirim", "%", "kampanya")
TOO_BROAD = ("kozmetik", "supermarket", "gida", "el", "erkek", "bakim", "icecek", "sivi", "kati", "bebek", "kedi", "kopek", "bakim urun", "temizleyici")
GENDERS = ("erkek", "men", "bay", "man", "kadin", "women", "bayan", "woman", "cocuk", "child", "children", "bebe", "unisex")
FILTER_STOPWORDS = ("ve", "and", "ile", "adet", "for", "icin", "veya", "li", "lu", "ml", "gr", "kg", "lt")
COLOR_TWINS = {"blue": "mavi", "beyaz": "white", "siyah": "black", "kirmizi": "red", "altin": "gold", "yellow": "sari", "green": "yesil", "dark": "koyu"}
NO_STOCK = "Stokta Yok"
REQUIRED = ("link", "name", "price", "market", "src")
# ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Markets and thresholds of a deployment."""

    visible: tuple[str, ...] = ()
    name_rank: dict[str, int] = field(default_factory=dict)
    src_rank: dict[str, int] = field(default_factory=dict)
    product_market: str = "gratis"
    variant_marker: str = "?sku"
    link_key: tuple[str, str] | None = None
    most_spread: float = 3.0
    deal_share: float = 0.7
    deal_prices: int = 4
    most_bad_items: int = 100
    least_seen_share: float = 0.25
    sub_brand_prefix: int = 4
    brand_prefix: int = 4
