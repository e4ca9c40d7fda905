"""The library's functions under SQL names, for spark.sql."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weftline.functions import exact
from weftline.sources import xml_units

UDFS = {"weft_exact_key": exact.exact_key_udf, "weft_letters": exact.letters_udf, "weft_leakage_key": exact.leakage_key_udf, "weft_leakage_skeleton": exact.leakage_skeleton_udf, "weft_overlap_key": exact.overlap_key_udf, "weft_clean": exact.clean_udf, "weft_standardize": exact.standardize_udf}


@F.udtf(returnType="xml_id string, element_tag string, element_index int, row_type string, form string, translations int, error string")
class XmlUnits:
    """The units of one XML file: weft_xml_units(path, content)."""

    def eval(self, path: str, content: bytes) -> Iterator[tuple]:
        for r in xml_units.parse(path, bytes(content)):
            yield r[4], r[2], r[3], r[6], r[7], len(r[10]), r[11]


def register(spark: SparkSession) -> None:
    for name, f in UDFS.items():
        spark.udf.register(name, f)
    spark.udtf.register("weft_xml_units", XmlUnits)


def usable_text(raw: str) -> str:
    """The standardized text of an inference input; raises if it isn't accepted."""
    out = exact.standardize(raw)
    if out["status"] != "accepted":
        raise ValueError(f"{out['status']}: {out['reason']}")
    return out["text"]
