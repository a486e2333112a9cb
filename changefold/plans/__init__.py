from . import candidates, gold, incremental, instalments, panels, silver
from .refresh import Layout, land, refresh

__all__ = ["candidates", "gold", "incremental", "instalments", "panels", "silver", "Layout", "land", "refresh"]
