"""Event-log analytics for behavioural rigs, and training-data operators, on PySpark."""
