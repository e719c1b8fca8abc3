"""chronoflow: DataFrame operators for dated, sourced text records."""
