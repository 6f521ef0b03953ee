"""String functions over columns: references, slugs, tasks, names and labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rule tables, the first hit wins.
SLUG_KEYS = ("laion-5b", "laion", "ava", "aadb", "ffhq", "coco", "flickr")
ALTERNATES = (("ava-aesthetic", "ava"), ("aadb", "aadb"), ("koniq", "koniq10k"))
TASKS = (
    ("diffusion", ("diffusion",)),
    ("segmentation", ("seg", "mask", "parsenet")),
    ("pose", ("pose", "face", "codeformer")),
    ("quality", ("nima", "aesthetic", "quality")),
    ("super-resolution", ("sr", "ultrazoom", "x2", "x3", "x4", "x8", "super")),
    (
        "restoration",
        tuple("restorer enhance upn lowlight exposure deraining debluring denoising haze restoration ffanet mirnet mprnet nafnet".split()),
    ),
)
DISPLAY = {
    "celebamask": "CelebAMask",
    "affectnet": "AffectNet",
    "wflw": "WFLW",
    "ffhq": "FFHQ",
    "helen": "Helen",
    "ava": "AVA",
    "aadb": "AADB",
    "coco": "COCO",
    "csiq": "CSIQ",
    "spaq": "SPAQ",
    "live": "LIVE",
    "koniq10k": "KonIQ-10k",
    "tid2013": "TID2013",
    "laion": "LAION",
    "laion-5b": "LAION-5B",
}


def _first(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases), otherwise)


def without_archive_suffix(name: Column) -> Column:
    return F.replace(F.replace(F.replace(name, F.lit(".tgz"), F.lit("")), F.lit(".tar.gz"), F.lit("")), F.lit(".zip"), F.lit(""))


def ref_slug(ref: Column) -> Column:
    """Last path segment of a reference; of ``repo:file`` the file without archive endings."""
    last = F.element_at(F.split(F.replace(ref, F.lit("hf://"), F.lit("")), "/"), -1)
    return F.when(F.contains(last, F.lit(":")), without_archive_suffix(F.element_at(F.split(last, ":"), -1))).otherwise(last)


def ref_repo(ref: Column) -> Column:
    """The repository of ``repo:file`` (up to the first colon), after ``hf://`` and ``competition:`` are taken off."""
    bare = F.replace(ref, F.lit("hf://"), F.lit(""))
    bare = F.when(F.contains(bare, F.lit("competition:")), F.regexp_extract(bare, "competition:(.*)", 1)).otherwise(bare)
    return F.split(bare, ":", 2)[0]


def ref_file(ref: Column) -> Column:
    """The file of ``repo:file``, null where none is named."""
    return F.get(F.split(F.replace(ref, F.lit("hf://"), F.lit("")), ":", 2), F.lit(1))


def alternate_slug(slug: Column) -> Column:
    """Short folder name of some sources, null for all others."""
    return _first([(F.contains(F.lower(slug), F.lit(k)), F.lit(v)) for k, v in ALTERNATES], F.lit(None).cast("string"))


def clean_slug(slug: Column) -> Column:
    """First known key that the lower-cased slug contains, else what stands before its first dash."""
    return _first([(F.contains(F.lower(slug), F.lit(k)), F.lit(k)) for k in SLUG_KEYS], F.substring_index(slug, "-", 1))


def detect_task(key: Column) -> Column:
    low = F.lower(key)
    cases = [(F.coalesce(low, F.lit("")) == "", F.lit("quality"))]
    for task, words in TASKS:
        cases.append((reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words]), F.lit(task)))
    return _first(cases, F.lit("detection"))


def legacy_name(prefix: Column, idx: Column) -> Column:
    """The name that older registries gave a sample, without its source."""
    return F.format_string("%s_%09d", prefix, idx)


def sample_name(prefix: Column, slug: Column, idx: Column) -> Column:
    return F.format_string("%s_%s_%09d", prefix, slug, idx.cast("long"))


def dataset_name(prefix: Column, key: Column, name: Column, suffix: Column) -> Column:
    return F.concat(prefix, F.coalesce(name, F.replace(key, F.lit("_"), F.lit(""))), suffix)


def name_source(name: Column, source: Column) -> Column:
    """What stands between a sample name's first and last part; the given source where there are under three parts."""
    parts = F.split(name, "_")
    return F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, 2, F.size(parts) - 2), "_")).otherwise(source)


def name_second_part(name: Column) -> Column:
    return F.coalesce(F.get(F.split(name, "_"), F.lit(1)), F.lit("unknown"))


def slug_of_name(name: Column, prefix: str) -> Column:
    """Slug of a sample name, whatever it contains: the prefix and the trailing number are taken off."""
    return F.regexp_extract(name, f"^{prefix}_(.*)_[0-9]{{9,}}$", 1)


def title_case(s: Column) -> Column:
    """Every letter that follows none is upper, all others are lower."""
    pieces = F.split(s, "(?<=[^A-Za-z])")
    return F.array_join(F.transform(pieces, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))), "")


def display_source(source: Column) -> Column:
    low = F.lower(source)
    return _first([(low == k, F.lit(v)) for k, v in DISPLAY.items()], title_case(source))


def strip_suffix(name: Column, old: Column, new: Column) -> Column:
    return F.concat(F.when((F.length(old) > 0) & F.endswith(name, old), F.left(name, F.length(name) - F.length(old))).otherwise(name), new)


def taxonomy_key(name: Column) -> Column:
    return F.lower(F.trim(name))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def extension(path: Column) -> Column:
    return F.regexp_extract(file_name(path), r"(?<=.)(\.[^.]*)$", 1)


def shard_name(prefix: Column, source: Column, suffix: Column) -> Column:
    return F.concat(prefix, source, suffix, F.lit(".tar"))


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def kebab(s: Column) -> Column:
    return F.replace(F.replace(F.lower(s), F.lit(" "), F.lit("-")), F.lit("_"), F.lit("-"))


def pad_right(s: Column, width: int) -> Column:
    """Padded with spaces, never cut."""
    return F.rpad(s, F.greatest(F.lit(width), F.length(s)), F.lit(" "))
