"""Lodestream: a PySpark-native engine for mining, classifying and evaluating large post dumps.

Subpackages: ``sources`` (readers and writers), ``functions`` (column expressions), ``operators``
(DataFrame to DataFrame), ``plans`` (sessions, shared tables, query registry), ``streaming`` and
``llm`` (operators on training data; nothing outside it imports it).
"""
