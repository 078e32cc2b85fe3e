"""DataFrame operators: de-duplication, merge, ordering, paging, audit, life cycle."""
