"""Driver tables seen as CI data, the registered queries, and their SQL twins."""
