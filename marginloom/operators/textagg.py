"""Distinct text lists."""


def joined_distinct(col: str, separator: str = ", ") -> str:
    """Aggregate: distinct non-NULL texts in ascending order; NULL if there is none.

    For groups whose distinct texts are few (names of the agents on one call): the set is
    built with partial aggregation, so copies are dropped before the shuffle.
    """
    names = f"array_sort(collect_set({col}))"
    return f"if(size({names}) > 0, array_join({names}, '{separator}'), NULL)"
