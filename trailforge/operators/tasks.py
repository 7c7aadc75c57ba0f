"""Tasks from repositories: instructions per package, and failures that are planted and kept only if a test sees them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import VERIFIERS


def from_packages(packages: DataFrame, repository: str, fixture: str, verification=("go_test",)) -> DataFrame:
    """schemas.TASK of harvested directories."""
    assert set(verification) <= set(VERIFIERS)
    ident = F.concat(F.lit(repository), F.lit(":"), "directory")
    prompt = F.concat(F.lit("The tests of ./"), "directory", F.lit(" fail. Find the cause, mend it, and run the tests again."))
    return packages.select(
        ident.alias("id"), F.lit(repository).alias("repository"), F.col("directory").alias("package"), prompt.alias("prompt"), F.array(*map(F.lit, verification)).alias("verification"),
        F.lit(fixture).alias("fixture"), F.lit(False).alias("has_images"), F.create_map(F.lit("source"), F.lit("harvest")).alias("metadata"),
    )


@dataclass
class Planted:
    kept: list[str] = field(default_factory=list)
    considered: int = 0
    already_failing: int = 0
    nothing_to_flip: int = 0
    survived_the_change: int = 0


def plant_failures(packages: list[str], passes: Callable[[str], bool], sources: Callable[[str], dict[str, str]], write: Callable[[str, str], None], limit: int = 0) -> Planted:
    """Flip the first equality of a package's sources until its tests fail; a flip that no test sees is taken back.

    passes(package), sources(package) -> {path: text} and write(path, text) are hooks; 0: no limit."""
    from .text_ops import flip

    found = Planted()
    for package in packages:
        if limit and len(found.kept) >= limit:
            break
        found.considered += 1
        if not passes(package):
            found.already_failing += 1
            continue
        flips = {p: f for p, t in sorted(sources(package).items()) if (f := flip(t)) is not None}
        if not flips:
            found.nothing_to_flip += 1
            continue
        texts = sources(package)
        for path, changed in flips.items():
            write(path, changed)
            if not passes(package):
                found.kept.append(package)
                break
            write(path, texts[path])
        else:
            found.survived_the_change += 1
    return found
