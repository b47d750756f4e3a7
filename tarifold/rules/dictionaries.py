"""Brand and make dictionaries and the navigation denylists (fixed values)."""

# Brands that are collected by default, by priority.
BRANDS = [
    "akrapovic", "arrow", "sc-project", "mivv", "yoshimura", "leovince", "remus", "gpr",
    "termignoni", "ixil", "scorpion", "zard", "laser", "two-brothers", "vance-hines", "cobra",
    "hp-corse", "qd", "bodis", "bos", "hurric", "giannelli", "marving", "motad", "exan",
    "delkevic", "tecnigas", "sito", "storm", "supertrapp", "silvertail", "predator", "mac",
    "ix-race", "fmf",
]

# Spelling (lower case) to display name.
BRAND_NAMES = {
    "akrapovic": "Akrapovic", "akrapovič": "Akrapovic", "arrow": "Arrow",
    "sc-project": "SC-Project", "sc project": "SC-Project", "mivv": "Mivv",
    "yoshimura": "Yoshimura", "leovince": "LeoVince", "leo vince": "LeoVince",
    "remus": "Remus", "gpr": "GPR", "termignoni": "Termignoni", "ixil": "Ixil",
    "spark": "Spark", "zard": "Zard", "scorpion": "Scorpion", "laser": "Laser",
    "racefit": "Racefit", "austin-racing": "Austin Racing", "austin racing": "Austin Racing",
    "two brothers": "Two Brothers", "hindle": "Hindle", "cobra": "Cobra",
    "vance & hines": "Vance & Hines", "vance and hines": "Vance & Hines",
    "graves": "Graves Motorsports", "qd exhaust": "QD Exhaust", "hp corse": "HP Corse",
    "hpcorse": "HP Corse", "takkoni": "Takkoni", "brocks": "Brocks", "rizoma": "Rizoma",
    "two-brothers": "Two Brothers", "vance-hines": "Vance & Hines", "hp-corse": "HP Corse",
    "qd": "QD Exhaust", "bodis": "Bodis", "bos": "Bos", "hurric": "Hurric",
    "giannelli": "Giannelli", "marving": "Marving", "motad": "Motad", "exan": "Exan",
    "delkevic": "Delkevic", "tecnigas": "Tecnigas", "sito": "Sito", "storm": "Storm",
    "supertrapp": "Supertrapp", "silvertail": "Silvertail", "predator": "Predator",
    "mac": "MAC", "ix-race": "IX-Race", "fmf": "FMF",
}

# Motorcycle makes; the order decides which one a title is given.
MAKES = [
    "Harley-Davidson", "Royal Enfield", "MV Agusta", "Husqvarna", "Gas Gas", "GasGas",
    "Moto Guzzi", "TM Racing", "Husaberg", "SWM", "Honda", "Yamaha", "Kawasaki", "Suzuki",
    "BMW", "Ducati", "KTM", "Triumph", "Aprilia", "Benelli", "CFMoto", "Zontes", "Indian",
    "Beta", "Sherco", "Piaggio", "Vespa", "Kymco", "Sym", "Peugeot", "Brixton", "Norton",
    "Zero", "Energica",
]

# Make alias (lower case) to display name.
MAKE_NAMES = {
    "harley": "Harley-Davidson", "hd": "Harley-Davidson", "harley davidson": "Harley-Davidson",
    "royal enfield": "Royal Enfield", "mv agusta": "MV Agusta", "mva": "MV Agusta",
    "bmw": "BMW", "ktm": "KTM", "gasgas": "GasGas", "gas gas": "GasGas",
    "moto guzzi": "Moto Guzzi", "husqvarna": "Husqvarna", "husaberg": "Husaberg",
}

# Navigation texts that are never a breadcrumb.
BREADCRUMB_DENYLIST = [
    "home", "winkel", "shop", "contact", "verzending", "retour", "garantie", "over ons", "faq",
    "vacatures", "sponsoring", "privacy", "algemene voorwaarden", "tax free", "outlet",
    "alle merken", "alle producten", "producten", "merken", "onderhoud", "olie", "blog",
    "nieuws",
]

# Navigation texts that are never a category tag.
CATEGORY_DENYLIST = BREADCRUMB_DENYLIST + [
    "service", "sitemap", "veelgestelde vragen", "tax free shopping", "outlet aanbiedingen",
]

# Row labels of a fitment table, and the captions that mark one.
MAKE_LABELS = ["merk", "merk motor", "fabrikant", "make", "brand motor", "motortype"]
MODEL_LABELS = ["model", "model motor", "type", "uitvoering", "motormodel"]
YEAR_LABELS = ["bouwjaar", "jaar", "year", "jaargang", "bj", "bouwjaren"]
FITMENT_CAPTION = "fitment|compatibility|geschikt|passend|motor|motorfiets"
ATTRIBUTE_TABLE_CLASS = "woocommerce-product-attributes|shop_attributes|product-attributes"

# Path segments of pages that are not products, and the product path form.
NON_PRODUCT_SEGMENTS = [
    "alle-merken", "alle-producten", "motormerk", "uitlaten-tuning", "faq", "over-ons",
    "contact", "cart", "checkout", "account", "login", "register", "search", "categorie",
    "category", "tag", "page", "filter", "verzending", "vacatures", "garantie-retouren",
    "onderhoud-motorfiets", "tax-free-shopping", "privacyverklaring", "sponsoring", "producten",
    "algemene-voorwaarden", "olie-kiezen(?:-oliekeuzehulp)?", "outlet-aanbiedingen", "nieuws",
    "blog", "sitemap", "service", "veelgestelde",
]
PRODUCT_PATH = r"^/[a-z0-9][a-z0-9\-]{3,}$"
