"""Folders of images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hydrolens.functions.text import UPLOAD_TYPES, base_name, file_name

DATASET_TYPES = ["png", "jpg", "jpeg"]


def name_pattern(types: list[str], case: str = "both") -> str:
    """Glob for file names by extension: 'lower', 'both' (all lower or all upper) or 'any' case."""
    if case == "any":
        forms = ["".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in t) for t in types]
    elif case in ("lower", "both"):
        forms = types + ([t.upper() for t in types] if case == "both" else [])
    else:
        raise ValueError(f"case is 'lower', 'both' or 'any', not {case!r}")
    return "*.{" + ",".join(forms) + "}"


def read_images(
    spark: SparkSession,
    paths: str | list[str],
    types: list[str] | None = UPLOAD_TYPES,
    case: str = "both",
    valid_only: bool = False,
) -> DataFrame:
    """(path, name, base, image) of every image; a file that does not decode has image.height -1.

    `types` are the file extensions to read; None reads every file.
    """
    source = spark.read.format("image").option("dropInvalid", valid_only)
    source = source.option("pathGlobFilter", name_pattern(types, case)) if types else source
    path = plain_path(F.col("image.origin"))
    return source.load(paths).select(
        path.alias("path"), file_name(path).alias("name"), base_name(path).alias("base"), "image"
    )


def read_dataset(spark: SparkSession, image_dir: str, mask_dir: str, on_missing: str = "fail") -> DataFrame:
    """Image and mask of the same file name: (name, image_path, mask_path). Listing only, no bytes."""
    from hydrolens.operators.lookup import pair_by_name

    def listing(folder: str, label: str) -> DataFrame:
        files = spark.read.format("binaryFile").option("pathGlobFilter", name_pattern(DATASET_TYPES, "any")).load(folder)
        return files.select(file_name(F.col("path")).alias("name"), F.col("path").alias(label))

    return pair_by_name(listing(image_dir, "image_path"), listing(mask_dir, "mask_path"), "name", on_missing)


def plain_path(origin: Column) -> Column:
    """The image source's URL-encoded origin as the path other file sources show."""
    decoded = F.url_decode(F.regexp_replace(origin, r"\+", "%2B"))
    return F.regexp_replace(decoded, "^([a-z]+):///", "$1:/")


def attach_truth(images: DataFrame, masks: DataFrame) -> DataFrame:
    """Left join of images (with `base`) to their truth mask.

    Several masks may share a base name; the first extension in png, jpg, jpeg, bmp, tiff whose
    file decodes is used. `masks` has path, base and image, like `read_images`. Which one that is comes
    from paths and sizes alone; of the pixels only those of the chosen masks go on.
    """
    kind = F.array_position(F.array(*[F.lit(t) for t in UPLOAD_TYPES]), F.substring_index("path", ".", -1))
    usable = masks.select("base", "path", F.col("image.height").alias("_height"), kind.alias("_rank")).where("_height > 0 AND _rank > 0")
    chosen = usable.groupBy("base").agg(F.min_by("path", F.struct("_rank", "path")).alias("path"))
    truth = masks.join(chosen, ["base", "path"], "left_semi").select("base", F.col("path").alias("truth_path"), F.col("image").alias("truth"))
    return images.join(truth, "base", "left").select(*images.columns, "truth_path", "truth")
