"""Queries registered for the driver, grouped as the operators are."""


def load():
    """Import all groups once and return the registry module."""
    from stopline.bindings import (  # noqa: F401
        common, jobs, joins_sets, modelling, prepare, scalars, statistics,
    )

    return common
