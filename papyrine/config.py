"""Settings from the environment or a .env file; unknown keys are ignored."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    ncbi_api_key: str | None = None
    ncbi_email: str = "user@example.com"
    uspto_api_key: str | None = None
    epo_key: str | None = None
    epo_secret: str | None = None
    serpapi_key: str | None = None
    output_dir: Path = Path("./data")
    log_level: str = "INFO"

    @property
    def ncbi_rate_limit(self) -> int:
        return 10 if self.ncbi_api_key else 3


def get_settings(env_file: str = ".env") -> Settings:
    """The environment goes before the file; names don't depend on case."""
    found: dict[str, str] = {}
    path = Path(env_file)
    if path.is_file():
        for line in path.read_text().splitlines():
            name, is_pair, value = line.strip().partition("=")
            if is_pair and not name.startswith("#"):
                found[name.removeprefix("export ").strip().lower()] = value.strip().strip("'\"")
    found |= {k.lower(): v for k, v in os.environ.items()}
    given = {f.name: found[f.name] for f in fields(Settings) if found.get(f.name)}
    if "output_dir" in given:
        given["output_dir"] = Path(given["output_dir"])
    return Settings(**given)
