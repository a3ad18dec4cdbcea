"""derlem: a PySpark-native engine for curating question-answer text corpora."""
