"""Job plans: the batch transform, the query registry and its SQL oracle."""
