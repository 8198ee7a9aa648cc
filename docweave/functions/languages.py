"""Languages as upper-case English names with their ISO 639 codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: name alpha-2 alpha-3 (fixed values, ISO 639).
LANGUAGES = """
ARABIC ar ara; BENGALI bn ben; BULGARIAN bg bul; CATALAN ca cat; CHINESE zh zho; CROATIAN hr hrv; CZECH cs ces; DANISH da dan;
DUTCH nl nld; ENGLISH en eng; ESTONIAN et est; FINNISH fi fin; FRENCH fr fra; GERMAN de deu; GREEK el ell; HEBREW he heb;
HINDI hi hin; HUNGARIAN hu hun; INDONESIAN id ind; ITALIAN it ita; JAPANESE ja jpn; KOREAN ko kor; LATVIAN lv lav; LITHUANIAN lt lit;
MALAY ms msa; NORWEGIAN no nor; PERSIAN fa fas; POLISH pl pol; PORTUGUESE pt por; ROMANIAN ro ron; RUSSIAN ru rus; SLOVAK sk slk;
SLOVENIAN sl slv; SPANISH es spa; SWEDISH sv swe; THAI th tha; TURKISH tr tur; UKRAINIAN uk ukr; URDU ur urd; VIETNAMESE vi vie
"""


def table(spark: SparkSession) -> DataFrame:
    """name, alpha2, alpha3; a dimension of fixed size."""
    return spark.createDataFrame([tuple(x.split()) for x in LANGUAGES.split(";")], "name string, alpha2 string, alpha3 string")


def with_codes(df: DataFrame, language: str = "language") -> DataFrame:
    """Adds alpha2 and alpha3; unknown names get null."""
    codes = table(df.sparkSession).withColumnRenamed("name", language)
    return df.join(F.broadcast(codes), language, "left")


def is_known(name: Column) -> Column:
    return name.isin([x.split()[0] for x in LANGUAGES.split(";")])


def is_tag(tag: Column) -> Column:
    """Whether a text has the form of a BCP-47 tag: language, then script, region, variants, extensions or private use."""
    return tag.rlike(r"^(?i:(?:[a-z]{2,3}(?:-[a-z]{3}){0,3}|[a-z]{4,8})(?:-[a-z]{4})?(?:-(?:[a-z]{2}|\d{3}))?(?:-(?:[a-z0-9]{5,8}|\d[a-z0-9]{3}))*(?:-[0-9a-wy-z](?:-[a-z0-9]{2,8})+)*(?:-x(?:-[a-z0-9]{1,8})+)?)$")


def model_name(model: str, source_alpha2: Column, target_alpha2: Column) -> Column:
    """(task, model) of a translation pair."""
    task = F.concat(F.lit("translation_"), source_alpha2, F.lit("_to_"), target_alpha2)
    return F.struct(task.alias("task"), F.concat_ws("-", F.lit(model), source_alpha2, target_alpha2).alias("model"))


def prompt(text: Column, target: Column) -> Column:
    """Instruction for a translating chat model (fixed wording)."""
    return F.concat(F.lit("Translate into "), target, F.lit(", without additional explanation: "), text)


def strip_prefix(text: Column, prefix: Column) -> Column:
    """The text without the target prefix where it starts with one."""
    return F.when((F.coalesce(prefix, F.lit("")) != "") & text.startswith(prefix), text.substr(F.length(prefix) + 1, F.length(text))).otherwise(text)
