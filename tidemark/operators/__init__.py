"""DataFrame -> DataFrame transformations.  None of them runs an action unless it says so."""
