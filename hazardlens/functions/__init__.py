"""Column-expression builders (pure functions returning ``Column``)."""
