"""Entity resolution on Spark: profiles in, golden records, deltas and manifests out."""

__version__ = "0.1.0"
