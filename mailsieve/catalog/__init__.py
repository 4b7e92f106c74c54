"""Registered queries, one module per area; importing this package registers all of them."""

from importlib import import_module
from pkgutil import iter_modules

for _m in iter_modules(__path__):
    import_module(f"{__name__}.{_m.name}")
