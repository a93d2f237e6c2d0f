"""The queries over the given tables, each with its SQL where SQL can say it."""


def load():
    """(queries, sql) with every query module imported."""
    import importlib
    import pkgutil

    from pulsegrid.suite.registry import QUERIES, SQL

    for mod in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{mod.name}")
    return QUERIES, SQL
