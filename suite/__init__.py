"""The registered queries, one per operator, with their oracles."""


def load_all():
    from . import merging, pages, runs, scalars, selects  # noqa: F401
