"""Paths and four-part document targets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.bounds import MAX_PATH_BYTES
from ledgerloom.functions.ident import is_slug
from ledgerloom.functions.text import is_nfc

# The layers of the document hierarchy, outermost first, with the
# parts of a target that each of them names.
LAYER_PARTS: Mapping[str, tuple[str, ...]] = {
    "xltm": (),
    "ltm": ("tree",),
    "mtm": ("tree", "branch"),
    "stm": ("tree", "branch", "leaf"),
}
LAYERS = tuple(LAYER_PARTS)
LAYER_NUMBERS = {layer: number for number, layer in enumerate(LAYERS, start=1)}
PARTS = ("tree", "branch", "leaf")


def is_canonical_path(path: Column) -> Column:
    """Relative NFC path in canonical form: no empty, ``.`` or ``..`` part."""
    parts = F.split(path, "/", -1)
    ok = (
        (path != "")
        & (F.octet_length(path) <= MAX_PATH_BYTES)
        & ~path.rlike(r"[\\\x00-\x1f\x7f]")
        & ~F.exists(parts, lambda part: part.isin("", ".", ".."))
        & is_nfc(path)
    )
    return F.coalesce(ok, F.lit(False))


def is_valid_target(target: Column) -> Column:
    """Whether a target names exactly the parts its layer requires, as slugs."""
    valid = F.lit(False)
    for layer, named in LAYER_PARTS.items():
        shape = target["layer"] == layer
        for part in PARTS:
            shape = shape & (is_slug(target[part]) if part in named else target[part].isNull())
        valid = valid | F.coalesce(shape, F.lit(False))
    return valid


def target_key(target: Column) -> Column:
    """Target as one string: layer and parts, missing parts empty."""
    parts = [F.coalesce(target[part], F.lit("")) for part in PARTS]
    return F.concat_ws("/", target["layer"], *parts)


def route_key(layer: Column, tree: Column, branch: Column, leaf: Column) -> Column:
    """Key of a document's route: parts its layer does not name are dropped."""
    named = {"tree": tree, "branch": branch, "leaf": leaf}

    def kept(part: str) -> Column:
        layers = [name for name, parts in LAYER_PARTS.items() if part in parts]
        return F.coalesce(F.when(layer.isin(*layers), named[part]), F.lit(""))

    return F.concat_ws("/", layer, *[kept(part) for part in PARTS])


def parent_key(key: Column) -> Column:
    """Key of the enclosing document, null for the outermost layer."""
    parts = F.split(key, "/", -1)
    outer: Column | None = None
    for layer, above in zip(LAYERS[1:], LAYERS, strict=False):
        kept = [
            parts[index] if part in LAYER_PARTS[above] else F.lit("")
            for index, part in enumerate(PARTS, start=1)
        ]
        value = F.concat_ws("/", F.lit(above), *kept)
        condition = parts[0] == layer
        outer = F.when(condition, value) if outer is None else outer.when(condition, value)
    return outer
