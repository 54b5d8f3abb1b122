"""The driver tables seen as the library's inputs, the registered queries, and their SQL counterparts."""
