"""Names, keys and labels of recordings, as Column -> Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Action phrases and conditions of the annotation vocabulary.
TIER2_ACTIONS = (
    "adjust_slider", "cap_pen", "close_wire_cutter", "cut_wire", "cut_tape", "insert_wire_into_lug", "label_sample", "measure_wire_length", "move_ruler", "move_wire",
    "move_wire_cutter", "move_lug", "move_plier", "move_pen", "move_scissor", "move_tape", "open_wire_cutter", "position_wire", "press_wire_cutter", "pull_out_tape",
    "put_ruler", "put_tape", "put_wire", "put_lug", "put_plier", "put_pen", "put_cap", "put_sample", "put_scissor", "put_wire_cutter", "remove_cap", "remove_tape",
    "take_ruler", "take_pen", "take_tape", "take_wire", "take_lug", "take_plier", "take_cap", "take_sample", "take_scissor", "take_wire_cutter", "tear_tape",
    "wrap_sample_with_tape", "wrap_short_wire_with_tape",
)
LIGHTS = ("normal", "right", "left")
POSITIONS = ("elbow", "mid")
SPLITS = ("train", "val", "test")
CAMERA_SIDES = {"front": 0, "back": 1}


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def one_form(c: Column) -> Column:
    return F.regexp_replace(F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_")), "_+", "_")


def tokens(c: Column) -> Column:
    return F.filter(F.split(one_form(c), "_"), lambda t: t != "")


def runs_through(needle: Column, hay: Column) -> Column:
    """needle's items occur in hay in order, not necessarily side by side. An empty needle does."""
    last = F.aggregate(hay, F.lit(0), lambda j, t: F.when(F.get(needle, j) == t, j + 1).otherwise(j))
    return last == F.size(needle)


def tier1(c: Column) -> Column:
    t = tokens(c)
    first = F.get(t, F.lit(0))
    return F.when((first == "pull") & (F.get(t, F.lit(1)) == "out"), F.lit("pull_out")).otherwise(F.coalesce(first, F.lit("unknown")))


def tier2(c: Column, vocabulary: tuple[str, ...] = TIER2_ACTIONS) -> Column:
    """The phrase of most tokens (then the first by name) that has the action's verb and is a subsequence of it.

    The vocabulary is a fixed list, so it goes into the expression and no join is needed.
    """
    verb = lambda w: "pull_out" if w[:2] == ["pull", "out"] else w[0]
    split = sorted(([w for w in v.split("_") if w] for v in vocabulary), key=lambda w: (-len(w), "_".join(w)))
    phrases = F.array(*[F.struct(F.lit("_".join(w)).alias("name"), F.lit(verb(w)).alias("verb"), F.array(*map(F.lit, w)).alias("tokens")) for w in split])
    found = F.get(F.filter(phrases, lambda p: (p["verb"] == tier1(c)) & runs_through(p["tokens"], tokens(c))), F.lit(0))
    return F.coalesce(found["name"], F.lit("UNMAPPED_T2"))


def one_of(c: Column, allowed: tuple[str, ...]) -> Column:
    return F.when(c.isin(*allowed), c).otherwise(F.lit("unknown"))


def lighting(segment: Column) -> Column:
    """By the last token but one; unknown where there are fewer than two."""
    t = tokens(segment)
    return F.when(F.size(t) < 2, F.lit("unknown")).otherwise(one_of(F.get(t, F.size(t) - 2), LIGHTS))


def position(segment: Column) -> Column:
    t = tokens(segment)
    return F.when(F.size(t) < 2, F.lit("unknown")).otherwise(one_of(F.get(t, F.size(t) - 1), POSITIONS))


def any_token(segment: Column, allowed: tuple[str, ...]) -> Column:
    """The first token, anywhere, that is allowed; null if none."""
    return F.get(F.filter(tokens(segment), lambda t: t.isin(*allowed)), F.lit(0))


def first_run(segment: Column) -> Column:
    """The first integer after a run_ that starts a word (an underscore before it doesn't); null if none."""
    return F.nullif(F.regexp_extract(F.lower(segment), r"\brun_(\d+)", 1), F.lit("")).cast("int")


def run_token(segment: Column) -> Column:
    """run_ and the number or range that a name begins with, as it is or else in its one form ("Run 3 ..."); run_UNKNOWN if neither has one."""
    number = lambda c: F.nullif(F.regexp_extract(c, r"(?i)^run_(\d+(?:-\d+)?)", 1), F.lit(""))
    return F.concat(F.lit("run_"), F.coalesce(number(strip(segment)), number(one_form(segment)), F.lit("UNKNOWN")))


def without_npy(c: Column) -> Column:
    return F.regexp_replace(strip(c), "(?i)_npy$", "")


def normalize_segment(c: Column, remove: tuple[str, ...] = ("_npy", "_mid")) -> Column:
    out = c
    for token in remove:
        out = F.replace(out, F.lit(token), F.lit(""))
    return F.regexp_replace(F.regexp_replace(out, "_{2,}", "_"), "^_+|_+$", "")


def safe_class(action: Column, obj: Column) -> Column:
    """action_object (or action alone) with what file systems forbid replaced."""
    a, o = strip(F.coalesce(action, F.lit(""))), strip(F.coalesce(obj, F.lit("")))
    name = F.when(o == "", a).otherwise(F.concat_ws("_", a, o))
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r'[\\/:*?"<>|\s]', "_"), "_+", "_"), "^_+|_+$", "")
    return F.when(name == "", F.lit("unknown")).otherwise(name)


def with_position(segment: Column, pos: Column) -> Column:
    """segment with pos added, before a trailing npy; unchanged if it names a position already."""
    has = F.exists(tokens(segment), lambda t: t.isin(*POSITIONS))
    stem = F.regexp_replace(segment, "_npy$", "")
    return F.when(has, segment).when(segment.endswith("_npy"), F.concat(stem, F.lit("_"), pos, F.lit("_npy"))).otherwise(F.concat_ws("_", segment, pos))


CLIP = r"^run_([0-9]+(?:[-_][0-9]+)?)_clip_([0-9]+)_([A-Za-z0-9_]+)$"


def clip_part(c: Column, k: int) -> Column:
    """1: run, 2: clip, 3: tag of a clip folder; null if it isn't one."""
    return F.nullif(F.regexp_extract(c, CLIP, k), F.lit(""))


def labels_from_key(key: Column) -> Column:
    """struct<prefix, label_1, label_2>: tokens up to the first run; label_1 joins those after the prefix, label_2 is the first of them."""
    t = F.split(key, "_")
    at = F.array_position(t, F.lit("run"))
    body = F.when(at >= 2, F.slice(t, F.lit(2), at.cast("int") - 2)).otherwise(F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0))))
    return F.struct(F.get(t, F.lit(0)).alias("prefix"), F.array_join(body, "_").alias("label_1"), F.coalesce(F.get(body, F.lit(0)), F.lit("")).alias("label_2"))


def sanitize_key(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(strip(c), r"[/\\]", "_"), r"\s+", "_"), "_+", "_")


def safe_key(style: str, original: Column, person: Column, action: Column, segment: Column) -> Column:
    """style: sanitize_only, or person_action_segment, where a missing part is that of the original key (its first token, its second, the rest), else UNKNOWN."""
    if style == "sanitize_only":
        return sanitize_key(original)
    if style != "person_action_segment":
        raise ValueError(f"unknown style {style!r}")
    t = F.filter(F.split(sanitize_key(F.coalesce(original, F.lit(""))), "_"), lambda x: x != "")
    inferred = (F.get(t, F.lit(0)), F.get(t, F.lit(1)), F.nullif(F.array_join(F.slice(t, F.lit(3), F.greatest(F.size(t) - 2, F.lit(0))), "_"), F.lit("")))
    unknown = ("UNKNOWN", "UNKNOWN_ACTION", "UNKNOWN_SEGMENT")
    return F.concat_ws("_", *[sanitize_key(F.coalesce(F.nullif(given, F.lit("")), part, F.lit(none))) for given, part, none in zip((person, action, segment), inferred, unknown, strict=True)])


def run_range(c: Column, style: str = "camera") -> Column:
    """struct<a, b, first> with a <= b, first as the name has it. camera: run_a or run_a-b; armband: run-a_emg or run-a-b_emg."""
    pattern = {"camera": r"^run_(\d+)(?:-(\d+))?$", "armband": r"run-(\d+)(?:-(\d+))?_emg"}[style]
    a = F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).cast("int")
    b = F.coalesce(F.nullif(F.regexp_extract(c, pattern, 2), F.lit("")).cast("int"), a)
    return F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), a.alias("first"))


# Which folder names are runs, for each kind of recording.
RUN_FOLDERS = {
    "camera": r"(?i)(?:^|_)run[-_]\d+(?:[-_]\d+)?$",
    "lidar": r"^run_",
    "copy": r"^run_(?:.*_)?\d+$",
    "depth": r"^run_\d+(?:_\d+)?$",
}


def is_run_folder(name: Column, kind: str) -> Column:
    return name.rlike(RUN_FOLDERS[kind])


def run_key(c: Column) -> Column:
    """1.0 -> 1, lower case, stripped."""
    return F.regexp_replace(F.lower(strip(c)), r"^(\d+)\.0$", "$1")


def first_token(c: Column, sep: str = "_", lower: bool = False) -> Column:
    out = F.get(F.split(c, sep, 2), F.lit(0))
    return F.lower(out) if lower else out


def key_of_path(path: Column) -> Column:
    return F.concat(F.array_join(F.split(path, "/"), "_"), F.lit("_npy"))


def out_path(path: Column) -> Column:
    """The output folder of an input folder: _npy on the leaf."""
    parts = F.split(path, "/")
    return F.array_join(F.concat(F.slice(parts, F.lit(1), F.size(parts) - 1), F.array(F.concat(F.element_at(parts, -1), F.lit("_npy")))), "/")


def run_tag(path: Column) -> Column:
    """parent/grandparent of a file."""
    p = F.split(path, "/")
    return F.concat_ws("/", F.try_element_at(p, F.lit(-2)), F.try_element_at(p, F.lit(-3)))


# Names for storage types.
DTYPES = {"fp16": "float", "float16": "float", "half": "float", "fp32": "float", "float32": "float", "single": "float", "fp64": "double", "float64": "double", "double": "double"}


def dtype(name: str) -> str:
    """The Spark type for a storage type name; 16-bit floats become float."""
    try:
        return DTYPES[name.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown type {name!r}") from None


def group_uid(person: Column, run: Column) -> Column:
    return F.concat_ws("::", person, run)


def split_key(person: Column, action: Column, segment: Column) -> Column:
    return F.concat_ws("/", person, action, without_npy(segment))


def renamed(c: Column, names: dict[str, str]) -> Column:
    """names[c], or c where it isn't named."""
    return F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in names.items()], c)


def unique_name(name: Column, ordinal: Column, suffix: str = "_dup") -> Column:
    """name for the first of its kind, then name_dup1 and so on; ordinal from row_number."""
    return F.when(ordinal == 1, name).otherwise(F.concat(name, F.lit(suffix), (ordinal - 1).cast("string")))
