"""The driver's tables in the shapes of this library, the registered queries and their oracles."""
