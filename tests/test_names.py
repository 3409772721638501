import unicodedata

from pyspark.sql import functions as F

from renown.functions.names import canonical_key
from renown.operators.identity import canonicalize_names
from renown.sources.dims import entity_dim, entity_list

# canonical name by spelling: accents, case, "&", spaces, hyphens, commas and dots
VARIANTS = {
    "Zoë Marée": "Zoe Maree",
    "SALT & COPPER": "Salt and Copper",
    "nine-lanterns": "Nine Lanterns",
    "Paper,Moth": "Papermoth",
    "D.O.R.A": "Dora",
    "El  Niño Gris": "El Nino Gris",
}
CONFIGURED = sorted(VARIANTS.values())


def keys(spark, names):
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(
        "n", canonical_key("n").alias("k")
    )
    return {row.n: row.k for row in rows.collect()}


def canonical(spark, names, configured=CONFIGURED, **options):
    df = spark.createDataFrame([(n, n) for n in names], "given string, entity_name string")
    dim = None if configured is None else entity_dim(entity_list(spark, configured))
    return {r.given: r.entity_name for r in canonicalize_names(df, dim, **options).collect()}


def test_variants_match_the_list(spark):
    assert canonical(spark, VARIANTS) == VARIANTS


def test_unknown_and_missing_names(spark):
    assert canonical(spark, ["Quiet Harbour", "", None, "東京"]) == {
        "Quiet Harbour": "Quiet Harbour",
        "": "Unknown",
        None: "Unknown",
        "東京": "東京",
    }
    assert canonical(spark, ["", None, "x"], unknown=None) == {"": "", None: None, "x": "x"}
    assert canonical(spark, ["DORA", None], configured=None) == {"DORA": "DORA", None: "Unknown"}


def test_name_without_key_in_the_list_matches_nothing(spark):
    assert canonical(spark, ["大阪", ""], ["東京", "Tool"]) == {"大阪": "大阪", "": "Unknown"}


def test_later_name_wins_a_clash(spark):
    assert canonical(spark, ["tool"], ["Tool", "Other", "TOOL"]) == {"tool": "TOOL"}


def test_keys_drop_what_has_no_decomposition(spark):
    assert keys(spark, ["Mø", "Æther", "Straße", "Łona", "ﬁre", "Ｔｏｏｌ＆", "Tōkyō", "①②", None]) == {
        "Mø": "m",
        "Æther": "ther",
        "Straße": "strae",
        "Łona": "ona",
        "ﬁre": "fire",
        "Ｔｏｏｌ＆": "tooland",
        "Tōkyō": "tokyo",
        "①②": "12",
        None: "",
    }


def test_keys_follow_unicode_for_every_character(spark):
    def expected(text):
        ascii_form = "".join(c for c in unicodedata.normalize("NFKD", text) if c.isascii())
        return "".join(c for c in ascii_form.replace("&", "and").lower() if c.isalnum())

    chars = [chr(c) for c in range(1, 0x1FC00) if not 0xD800 <= c < 0xE000]
    blocks = ["".join(chars[i : i + 7]) for i in range(0, len(chars), 7)]
    found = (
        spark.createDataFrame([(b,) for b in blocks], "n string")
        .repartition(4)
        .select("n", canonical_key(F.col("n")).alias("k"))
        .collect()
    )
    assert [(r.n, r.k) for r in found if r.k != expected(r.n)] == []
