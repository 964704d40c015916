"""Raw CSV readers, declared schemas and the Parquet layers."""

from carelayers.sources.layers import (
    as_view,
    layer_counts,
    layer_path,
    materialize,
    read_layer,
    shared_folder,
    write_counted,
    write_layer,
)
from carelayers.sources.raw import RawFolder, first_rows, read_raw, spread
from carelayers.sources.schemas import SCHEMAS, conform

__all__ = [
    "SCHEMAS",
    "RawFolder",
    "as_view",
    "conform",
    "first_rows",
    "layer_counts",
    "layer_path",
    "materialize",
    "read_layer",
    "read_raw",
    "shared_folder",
    "spread",
    "write_counted",
    "write_layer",
]
