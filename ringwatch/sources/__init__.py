"""Reading and writing call tables and fitted models."""
