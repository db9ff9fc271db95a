"""Every module of the package imports (no Spark session needed)."""

import importlib
import pkgutil

import strata


def test_all_modules_import():
    names = [m.name for m in pkgutil.walk_packages(strata.__path__, "strata.")]
    assert len(names) > 20
    for name in names:
        importlib.import_module(name)
