from pyspark.sql import functions as F

from tarifold.functions import money, seo, tags, text, wording, years
from tarifold.operators import fitment


def test_localised_prices(one):
    assert one(text.parse_price, "€ 1.299,00", "1.299", "1,299.00", "649,95", "", "abc", "$12.5", "1.5.5") == [
        1299.0, 1299.0, 0.0, 649.95, 0.0, 0.0, 12.5, 0.0]


def test_title_case_and_slugs(one):
    assert one(text.title_case, "2nd sc-project éreau", "HELLO wORLD") == ["2Nd Sc-Project Éreau", "Hello World"]
    assert one(text.tag_slug, "SC-Project", "Slip-On  Line", " a é ") == ["SC_Project", "Slip_On_Line", "a_é"]
    assert one(text.url_slug, "Akrapovič Slip-On", "ﬁne ½ ø", "--", "㎏ Ünï") == ["akrapovic-slip-on", "fine-12", "", "kg-uni"]


def test_markup_text(one):
    assert one(text.strip_tags, "<p>Hi</p> there") == ["Hi  there"]


def test_clean_year(one):
    assert one(years.clean_year, "2019 – 2023", "2019/2023", "2021 +", "2019-23", "2022", "") == [
        "2019-2023", "2019-2023", "2021+", "2019-2023", "2022", ""]


def test_expand_years(one):
    got = one(lambda y: years.expand_years(y, 2026), "2019-2023", "2021+", "2022", "", "2030-2040", "2023-2019", "2030+")
    assert got == [
        ["2019", "2020", "2021", "2022", "2023"],
        ["2021", "2022", "2023", "2024", "2025", "2026", "2021+"], ["2022"], [],
        [str(y) for y in range(2030, 2041)], ["2023-2019"], ["2030+"]]


def test_fitment_from_title(one):
    titles = {
        "Akrapovic Slip-On Honda CB650R 2019-2023": ("Honda", "CB650R", "2019-2023"),
        "Mivv Oval Carbon BMW S1000RR 2019+": ("BMW", "S1000RR", "2019+"),
        "Arrow Pro-Race Yamaha MT-09 2021+": ("Yamaha", "MT-09", "2021+"),
        "Remus HexaCone Triumph Street Triple R 2020-2023": ("Triumph", "Street Triple", "2020-2023"),
        "Akrapovic Racing Line KTM 890 Duke R 2020-2022": ("KTM", "890 Duke", "2020-2022"),
        "Mivv uitlaatdemper Oval carbon": ("", "", ""),
        "Arrow Pro-Race Kawasaki Z900 2020+": ("Kawasaki", "Z900", "2020+"),
        "Akrapovic Yamaha YZF-R1 2020+": ("Yamaha", "YZF-R1", "2020+"),
    }
    make = one(fitment.title_make, *titles)
    year = one(fitment.title_year, *titles)
    model = one(fitment.title_model, *[(t, m) for t, m in zip(titles, make)])
    assert list(zip(make, model, year)) == list(titles.values())


def test_names(one):
    assert one(fitment.normalize_brand, " AKRAPOVIČ ", "sc project", "unknown-brand", "") == [
        "Akrapovic", "SC-Project", "Unknown-Brand", ""]
    assert one(fitment.normalize_make, "hd", "GAS GAS", "ducati", "acme") == ["Harley-Davidson", "GasGas", "Ducati", "Acme"]


def test_prices(one):
    number = lambda f: lambda c: F.round(f(c.cast("double")), 2)
    assert one(number(money.net_price), "121", "649") == [100.0, 536.36]
    assert one(number(money.flat_export_price), "121", "649") == [135.0, 724.09]
    assert one(lambda c: money.money_text(c.cast("double")), "100", "804.5537", None) == ["100.00", "804.55", None]
    assert one(number(money.to_95), "738.5", "0", "99.4") == [738.95, -0.05, 98.95]
    listed = lambda c: money.percentile(F.from_json(c, "array<double>"), 0.6)
    assert one(listed, "[720,765,710,800]", "[5]") == [756.0, 5.0]


BASE = ("Akrapovic", "Honda", "CB650R", "2019-2023", "Akrapovic Slip-On Honda CB650R 2019-2023",
        "Titanium slip-on uitlaatdemper voor de Honda CB650R.", "Slip-On Uitlaten")


def build(*cs):
    return tags.build_tags(*cs, F.lit(False), 2026)


def test_tags(one):
    got = one(
        build, BASE,
        (*BASE[:4], "Akrapovic Racing Line Uitlaatsysteem Yamaha MT-09 2021+", "Volledig uitlaatsysteem van titanium.", "Home"),
        ("Arrow", "", "", "2021+", "Carbon RVS race", "Euro 5 e-keur", ""))
    assert got[0] == ["BRAND_Akrapovic", "MAKE_Honda", "MODEL_CB650R", *[f"YEAR_{y}" for y in range(2019, 2024)],
                      "TYPE_SlipOn", "MAT_Titanium", "CAT_Slip_On_Uitlaten", "source:source.example"]
    assert "TYPE_FullSystem" in got[1] and not any(t.startswith("CAT_") for t in got[1])
    assert got[2][1:] == [*[f"YEAR_{y}" for y in range(2021, 2027)], "YEAR_2021+", "MAT_Carbon", "MAT_StainlessSteel",
                          "EURO_5", "HOMOLOGATED", "source:source.example"]
    assert all(len(t) == len(set(t)) for t in got)


def test_seo(one):
    long = ("Akrapovic", "Slip-On Uitlaten", "Honda", "CBR1000RR-R Fireblade", "2020+")
    assert [len(x) for x in one(seo.seo_title, long)] == [70]
    assert one(seo.seo_title, ("Arrow", "Slip-On", "Yamaha", "MT-09", "2021+"), ("", "", "", "", "")) == [
        "Arrow Slip-On for Yamaha MT-09 2021+ | Example Store", " | Example Store"]
    meta = one(lambda b, m, d, y, p: seo.meta_description(b, m, d, y, p), ("A", "", "", "", ""))
    assert meta == ["A exhaust for the your motorcycle. Upgrade your exhaust at Example Store — worldwide shipping."]
    assert one(seo.alt_text, ("Akrapovic", "Slip-On", "Honda", "CB650R", ""), ("A", "B", "", "", "2020")) == [
        "Akrapovic Slip-On for Honda CB650R", "A B"]


def test_wording(one):
    assert one(wording.translate_title, "Volledig systeem RVS rvs Mat zwart voor Honda van x", "Demper Systeem", "Mat goud") == [
        "Full System Stainless Steel rvs Matte Black for Honda x", "Silencer Systeem", "Matte Gold"]
    assert one(wording.clean_description, "Hello. Source-shop is best! Keep me. De goedkoopste hier. <br><br/>\n\n ok", "") == [
        "Hello. Keep me. <br> ok", ""]
    assert one(wording.clean_description, "See source-shop.nl now. Stay.", "stel ons. een vraag. Bye.") == ["nl now. Stay.", "Bye."]
    blocks = lambda c: wording.numbered_blocks(c, F.lit(3))
    assert one(blocks, "x [1] a\nb [3] c [3] d\n", "") == [["a\nb", "", "d"], ["", "", ""]]
    assert one(wording.context_hint, ("A", "Demper", "", "M", "")) == ["A | Silencer | M"]
