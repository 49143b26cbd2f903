"""Training-data operators: quality, near-duplicates, privacy, packing and storage.

Nothing outside this subpackage imports it. ``queries`` registers the driver
queries, ``common`` holds the few shared helpers.
"""
