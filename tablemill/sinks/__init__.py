"""Writers. They give back the number of rows written."""
