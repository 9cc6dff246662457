"""Extension → handler routing (a literal map: the broadcast-join equivalent)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.paths import suffix
from ..options import DEFAULT_HANDLERS, OPTIONAL_HANDLERS


def build_registry(overrides: dict | None = None, optional_handlers=(), converters=()) -> dict[str, str]:
    """Extension (lower case) → handler name; overrides win; unknown names raise.

    ``converters`` names the handlers that the caller has a converter for.
    """
    registry = {ext.lower(): name for ext, name in DEFAULT_HANDLERS.items()}
    known = set(registry.values()) | {h for h in optional_handlers if h in OPTIONAL_HANDLERS} | set(converters)
    for ext, name in (overrides or {}).items():
        if name not in known:
            raise ValueError(f"Unknown extractor '{name}' for extension '{ext}'. Available: {sorted(known)}")
        registry[ext.lower()] = name
    return registry


def extension(path: Column) -> Column:
    """Lower-cased last suffix of the file name (``''`` when none)."""
    return F.lower(suffix(path))


def handler_for(path: Column, registry: dict[str, str]) -> Column:
    """Handler name for the path's extension, null when none is registered."""
    pairs = []
    for ext, name in sorted(registry.items()):
        pairs += [F.lit(ext), F.lit(name)]
    return F.element_at(F.create_map(*pairs), extension(path)) if pairs else F.lit(None).cast("string")


def no_handler_error(path: Column) -> Column:
    """``No extractor registered for extension: '<ext>'`` (Python repr quoting)."""
    return F.concat(F.lit("No extractor registered for extension: '"), extension(path), F.lit("'"))


@dataclass(frozen=True)
class BatchConverter:
    """A converter in Python: a function from a list of texts to as many intermediates.

    A batch that raises is tried again text by text, so that an error is the error of
    one document and the others of its batch are converted.
    """

    convert: Callable[[list[str]], list[str]]

    def column(self, text: Column) -> Column:
        """``struct<value, error>`` of a text; null texts (other handlers' rows) never reach the function."""
        convert = self.convert

        def batch(texts: list[str]) -> list[tuple[str | None, str | None]]:
            try:
                made = convert(texts)
                if len(made) != len(texts):
                    raise ValueError(f"{len(made)} intermediates for {len(texts)} texts")
                return [(m, None if m is not None else "The converter returned nothing") for m in made]
            except Exception as e:  # noqa: BLE001 - whatever a user's converter raises belongs to its document
                if len(texts) == 1:
                    return [(None, str(e) or type(e).__name__)]
                return [batch([t])[0] for t in texts]

        def run(texts: pd.Series) -> pd.DataFrame:
            value, error = np.full(len(texts), None, dtype=object), np.full(len(texts), None, dtype=object)
            asked = np.flatnonzero(texts.notna())
            if len(asked):
                for i, (v, e) in zip(asked, batch(texts.iloc[asked].tolist()), strict=True):
                    value[i], error[i] = v, e
            return pd.DataFrame({"value": value, "error": error})

        # not deterministic: value and error come from one call
        return F.pandas_udf(run, "value string, error string").asNondeterministic()(text)
