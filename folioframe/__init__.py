"""folioframe: DataFrame operators for digital-library catalogs and book corpora."""
