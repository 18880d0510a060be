"""Links, paths and classifier rules as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from partsieve.functions.text import first_group, strip

# Patterns of links, parts-list paths and file kinds.
URL = r"https?://[^\s,;)]+"
GIT_LINKS = [r"(?i)https?://(?:www\.)?github\.com/[^\s)\],;]+", r"(?i)https?://(?:www\.)?gitlab\.com/[^\s)\],;]+", r"(?i)https?://gitlab\.[^\s/]+/[^\s)\],;]+"]
OWNER_REPO = r"(?i)github\.com/([A-Za-z0-9_.-]+)/([A-Za-z0-9_.-]+)"
BOM_PATHS = [r"(^|/)bom[_\-.]", r"(^|/)bill[_\-]of[_\-]materials", r"(^|/)parts[_\-]?list", r"(^|/)components\.(csv|tsv|xlsx?|json|xml)", r"[_\-]bom\.(csv|tsv|xlsx?|json|xml)$"]
TABLE_EXTENSIONS = [".csv", ".tsv", ".txt", ".xlsx", ".xls", ".ods", ".xml"]
FALSE_PATHS = ["node_modules/", "/vendor/", "/test/fixtures/", "Design Data/GOST/", ".github/"]
# What marks a project as hardware, and what its name, folders and keywords say.
NOT_HARDWARE_WORDS = ["gateware", "software", "firmware", "gw", "sw", "fw"]
HARDWARE_EXTENSIONS = [".pcb", ".sch", ".brd", ".gbr", ".drl", ".kicad_pcb", ".lib", ".ipt", ".step", ".stl", ".dwg", ".ucf"]
HARDWARE_FOLDERS = ["hardware", "pcb", "eagle", "kicad", "gerber", "hw", "layout", "schematics", "schematic", "board", "rtl", "pcb_design", "cad"]
README_NAMES = ["README.md", "readme.md", "Readme.md", ".ohwr.yaml"]
KEYWORDS = {
    3: ["schematics", "schematic", "pcb", "circuit", "breakout board", "fpga mezzanine card", "hardware design", "sch", "sch diagram", "kicad", "bom", "bill of materials", "mechanical design", "assembly details", "eda"],
    2: ["hardware", "microcontroller", "i/o", "layout"],
    1: ["prototype", "board", "chip", "design", "device"],
}
HARDWARE_SCORE, AMBIGUOUS_SCORE = 20, 11


def _bare(url: Column) -> Column:
    return F.regexp_replace(strip(F.lower(url)), "/+$", "")


def osf_key(url: Column) -> Column:
    """osf.io/<key> of a link or DOI, else null."""
    return F.concat(F.lit("osf.io/"), first_group(F.replace(_bare(url), F.lit("doi.org/10.17605/osf.io/"), F.lit("osf.io/")), r"osf\.io/([a-z0-9]+)"))


def mendeley_key(url: Column) -> Column:
    """mendeley/<id> of a link or DOI, else null."""
    u = _bare(url)
    return F.concat(F.lit("mendeley/"), F.coalesce(first_group(u, r"data\.mendeley\.com/datasets/([a-z0-9]+)"), first_group(u, r"10\.17632/([a-z0-9]+)")))


def owner_repo(url: Column) -> Column:
    """struct(owner, repo) of a GitHub link, case kept, without .git; null fields for others."""
    u = F.regexp_replace(strip(url), "/+$", "")
    repo = F.nullif(F.regexp_replace(first_group(u, OWNER_REPO, 2), r"\.git$", ""), F.lit(""))
    return F.struct(F.when(repo.isNotNull(), first_group(u, OWNER_REPO)).alias("owner"), repo.alias("repo"))


def urls(text: Column) -> Column:
    """All links of a text, in order; null gives none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(URL), F.lit(0))


def first_repo_url(text: Column) -> Column:
    """The first GitHub or GitLab link of a text, else null."""
    git = lambda u: F.lower(u).contains("github.com") | F.lower(u).contains("gitlab.com")
    return F.get(F.filter(urls(text), git), F.lit(0))


def git_links(text: Column) -> Column:
    """Distinct links to git hosts, GitHub's first."""
    found = [F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(p), F.lit(0)) for p in GIT_LINKS]
    return F.array_distinct(F.concat(*found))


def extension(path: Column) -> Column:
    """Lower-cased extension with its dot, null without one."""
    return F.lower(first_group(path, r"(\.[^./]+)$"))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_bom_path(path: Column) -> Column:
    """A data file whose path names a parts list."""
    return F.lower(path).rlike(r"\.(csv|tsv|xlsx|xls|json|xml|yaml|yml|ods)$") & path.rlike("(?i)" + "|".join(BOM_PATHS))


def is_false_path(path: Column) -> Column:
    """A path of a folder that holds no parts lists of its own; case counts."""
    return reduce(lambda a, b: a | b, [path.contains(x) for x in FALSE_PATHS])


def structure_class(name: Column, paths: Column) -> Column:
    """Hardware or not by a project's name and the paths of its files."""
    words = F.split(F.lower(name), r"[\s_-]+")
    names = F.transform(paths, basename)
    folders = F.flatten(F.transform(paths, lambda p: F.slice(F.split(F.lower(p), "/"), 1, F.size(F.split(p, "/")) - 1)))
    said = lambda xs, wanted: F.arrays_overlap(xs, F.array(*map(F.lit, wanted)))
    only_readme = (F.size(F.array_except(names, F.array(*map(F.lit, README_NAMES)))) == 0) & F.size(names).between(1, 2)
    return (
        F.when(said(words, NOT_HARDWARE_WORDS), "not_hardware")
        .when(F.exists(paths, lambda p: F.coalesce(extension(p).isin(HARDWARE_EXTENSIONS), F.lit(False))), "hardware")
        .when(said(folders, HARDWARE_FOLDERS), "hardware")
        .when(only_readme, "ambiguous")
        .when(F.size(paths) == 0, "empty_respository")
        .otherwise("not_hardware")
    )


def occurrences(text: Column, word: str) -> Column:
    """How often a word occurs in a text, without overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))) / len(word)).cast("long")


def keyword_class(score: Column) -> Column:
    return F.when(score >= HARDWARE_SCORE, "hardware").when(score >= AMBIGUOUS_SCORE, "ambiguous").otherwise("not hardware")
