"""The catalogues of regions and banks as small dimension tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Region, name, tier, x, y, w, h as fractions of the aligned page, padding, engine route, allowed characters.
REGIONS = [
    ("R01", "payment_order", 2, 0.780, 0.080, 0.180, 0.080, 0.05, "tesseract", "digits"),
    ("R02", "echeance_upper", 1, 0.160, 0.090, 0.120, 0.080, 0.05, "tesseract", "any"),
    ("R03", "creation_date_upper", 1, 0.320, 0.090, 0.115, 0.080, 0.05, "tesseract", "any"),
    ("R04", "city_upper", 3, 0.265, 0.050, 0.110, 0.050, 0.05, "qwen", "any"),
    ("R05", "rib_upper", 1, 0.080, 0.165, 0.330, 0.085, 0.15, "tesseract_then_qwen", "digits"),
    ("R06", "amount_upper", 1, 0.800, 0.170, 0.170, 0.075, 0.05, "tesseract_then_qwen", "amount"),
    ("R07", "tireur", 2, 0.000, 0.250, 0.150, 0.085, 0.15, "qwen", "any"),
    ("R08", "beneficiary", 2, 0.150, 0.255, 0.270, 0.080, 0.05, "qwen", "any"),
    ("R09", "amount_text", 1, 0.140, 0.355, 0.430, 0.075, 0.05, "qwen", "any"),
    ("R10", "amount_lower", 1, 0.800, 0.265, 0.170, 0.080, 0.05, "tesseract_then_qwen", "amount"),
    ("R11", "city_lower", 3, 0.000, 0.465, 0.100, 0.065, 0.05, "qwen", "any"),
    ("R12", "creation_date_lower", 1, 0.100, 0.460, 0.130, 0.070, 0.05, "tesseract", "any"),
    ("R13", "echeance_lower", 1, 0.230, 0.460, 0.130, 0.070, 0.05, "tesseract", "any"),
    ("R14", "rib_lower", 1, 0.000, 0.545, 0.300, 0.085, 0.15, "tesseract_then_qwen", "digits"),
    ("R15", "drawee", 1, 0.295, 0.610, 0.270, 0.130, 0.15, "qwen", "any"),
    ("R16", "domiciliation", 2, 0.660, 0.560, 0.340, 0.170, 0.15, "qwen", "any"),
    ("R17", "barcode", 2, 0.460, 0.860, 0.370, 0.085, 0.02, "barcode_decoder", "any"),
]
# Bank code, bank name.
BANKS = [
    ("02", "STB"), ("03", "UIB"), ("04", "Attijari Bank"), ("05", "BNA"), ("07", "Amen Bank"), ("08", "BIAT"), ("10", "BT"), ("11", "UBCI"),
    ("12", "WIB"), ("14", "BH"), ("20", "BFT"), ("21", "TQB"), ("22", "ATB"), ("23", "NAIB"), ("24", "STUSID"), ("25", "Citibank"),
    ("26", "BFPME"), ("27", "BTL"), ("31", "BTS"), ("32", "BTK"), ("33", "BTI"), ("45", "ABC"),
]
ROI_IDS = [r[0] for r in REGIONS]
ROUTES = {r[0]: r[8] for r in REGIONS}
REGION_SCHEMA = "roi_id string, name string, tier int, x double, y double, w double, h double, padding double, route string, allowed string"
BANK_SCHEMA = "code string, bank_name string"


def regions(spark: SparkSession, *rois: str) -> DataFrame:
    """All regions, or those named."""
    return spark.createDataFrame([r for r in REGIONS if not rois or r[0] in rois], REGION_SCHEMA)


def banks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BANKS, BANK_SCHEMA)


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """A region catalogue in JSON: one object with a map of regions. Padding defaults to 0.05, the route to the first engine."""
    entry = "struct<name:string,tier:int,x:double,y:double,w:double,h:double,padding:double,ocr_engine:string,tesseract_config:string>"
    config = F.coalesce("v.tesseract_config", F.lit(""))
    allowed = F.when(~config.contains("whitelist"), "any").when(F.regexp_like(F.element_at(F.split(config, "whitelist="), -1), F.lit("[,.]")), "amount").otherwise("digits")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(F.from_json("value", f"struct<rois:map<string,{entry}>>")["rois"]).alias("roi_id", "v"))
        .select("roi_id", "v.name", "v.tier", "v.x", "v.y", "v.w", "v.h", F.coalesce("v.padding", F.lit(0.05)).alias("padding"), F.coalesce("v.ocr_engine", F.lit("tesseract")).alias("route"), allowed.alias("allowed"))
    )


def read_banks(spark: SparkSession, path: str) -> DataFrame:
    """A bank catalogue in JSON; without the file no bank is known."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], BANK_SCHEMA)
    return text.select(F.explode(F.from_json("value", T.StructType([T.StructField("bank_codes", T.MapType(T.StringType(), T.StringType()))]))["bank_codes"]).alias("code", "bank_name"))
