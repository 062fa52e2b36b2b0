"""plumbline: a PySpark-native engine for registries of public bodies and their web presence."""
