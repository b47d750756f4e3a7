"""Numbers, limits and store texts. All of them are defaults of operator arguments."""

from dataclasses import dataclass

# Pricing.
VAT_RATE = 1.21
DEFAULT_MARKUP = 1.35
MIN_MARGIN = 1.35
MAX_MARGIN = 1.80
HARD_FLOOR = 1.20
TARGET_PERCENTILE = 0.60
MIN_MATCHES = 2
COMPARE_AT_MARKUP = 1.50
COMPARE_AT_FRACTION = 0.30
COMPARE_AT_SEED = 42
MIN_CONFIDENCE = 0.75
# Matches at or above it are found through the index of near texts.
NEAR_CONFIDENCE = 0.96

# Images.
MIN_IMAGE_BYTES = 10_000
MIN_IMAGE_DIM = 800
MAX_IMAGES = 10
IMAGE_SKIP_FRAGMENTS = ["/logo", "/icon", "/banner", "/placeholder", "s.w.org", "data:"]

# Text.
TRANSLATION_BATCH = 10
SEO_TITLE_LENGTH = 70
META_DESCRIPTION_LENGTH = 150
WEIGHT_GRAMS = 5000

# Response codes with which a store blocks a reader.
BLOCK_STATUSES = [403, 429, 451]


@dataclass(frozen=True)
class Store:
    """Texts of the shop that owns the catalog; none of them affects matching or price."""

    name: str = "Example Store"
    source_site: str = "source.example"
    source_keyword: str = "source-shop"


# Constants of an import row.
EXPORT_CONSTANTS = {
    "Published": "TRUE",
    "Option1 Name": "Title",
    "Option1 Value": "Default Title",
    "Variant Grams": "5000",
    "Variant Inventory Tracker": "shopify",
    "Variant Inventory Qty": "1",
    "Variant Inventory Policy": "deny",
    "Variant Fulfillment Service": "manual",
    "Variant Taxable": "TRUE",
}

# Where a resized copy is kept, endings of image addresses, keys of gallery scripts, the folder of product
# images, and attributes that hold an image address, best first.
IMAGE_CACHE = r"/cache/[a-f0-9]{32}/"
IMAGE_EXTENSION = r"(?i)\.(?:jpe?g|png|webp|gif)"
GALLERY_KEYS = ["full", "img", "src", "url"]
PRODUCT_MEDIA = "/media/catalog/product/"
IMAGE_ATTRIBUTES = ["data-large_image", "data-src", "data-lazy-src", "data-original", "src"]
