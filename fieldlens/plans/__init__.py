"""Reports (plans) built from the operators, the stand-in views and the query registry."""
