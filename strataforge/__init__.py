"""Record-curation and corpus analytics expressed as PySpark DataFrame plans."""
