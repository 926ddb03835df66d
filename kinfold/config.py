"""Settings, from defaults and the environment (prefix SANCTION_)."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass
class Settings:
    PROJECT_NAME: str = "AML Project"
    PROVIDER_NAME: str = "kinfold"
    SANCTIONS_CONCURRENCY: int = 3
    LOG_LEVEL: str = "INFO"
    DATA_LAKE_DIR: str = field(default_factory=lambda: str(Path.cwd() / "data"))

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        """Defaults overridden by ``SANCTION_<FIELD>``; names are case-sensitive."""
        env = dict(os.environ) if env is None else env
        out = cls()
        for f in fields(cls):
            raw = env.get(f"SANCTION_{f.name}")
            if raw is not None:
                setattr(out, f.name, type(getattr(out, f.name))(raw))
        return out

    @property
    def raw_dir(self) -> Path:
        return Path(self.DATA_LAKE_DIR) / "raw"

    @property
    def processed_dir(self) -> Path:
        return Path(self.DATA_LAKE_DIR) / "schema"

    @property
    def output_dir(self) -> Path:
        return Path(self.DATA_LAKE_DIR) / "new_data"

    @property
    def processed(self) -> str | Path:
        """The folder of the profiles as Spark opens it: a URI below a data lake that is one."""
        return f"{self.DATA_LAKE_DIR.rstrip('/')}/schema" if "://" in self.DATA_LAKE_DIR else self.processed_dir

    @property
    def output(self) -> str | Path:
        return f"{self.DATA_LAKE_DIR.rstrip('/')}/new_data" if "://" in self.DATA_LAKE_DIR else self.output_dir

    def set_data_lake(self, path: str | Path) -> None:
        """Point to another data lake and make its folders."""
        self.DATA_LAKE_DIR = str(path)
        for folder in (self.raw_dir, self.processed_dir):
            folder.mkdir(parents=True, exist_ok=True)


@dataclass
class ResolverOptions:
    """The knobs of a resolver run."""

    max_block_size: int = 500
    provider: str = "kinfold"
    enable_delta: bool = True
    state_file: str | None = None
    excluded_data_fields: tuple[str, ...] = ("provider_version", "evidences", "notes")
    excluded_top_fields: tuple[str, ...] = ()
    debug_top_n: int = 20
    source_dir: str = ""

    def __post_init__(self) -> None:
        # an empty exclusion list means the default one
        self.excluded_data_fields = tuple(self.excluded_data_fields) or ResolverOptions.excluded_data_fields
        self.state_file = self.state_file or f"{self.provider}_state.json"
