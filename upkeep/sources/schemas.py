"""Schemas of the raw exports (fixed values: the column names of the input tables)."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, DOUBLE, TEXT, TIME = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType()


def _schema(groups: dict[T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for kind, names in groups.items() for name in names.split()])


# Times are text in the export and parsed by the cleaning step.
CORRECTIVE = _schema(
    {
        LONG: "id_ordre_travail id_demande nombre_main_doeuvre id_actif",
        DOUBLE: "cout_maindoeuvre cout_pdr cout_bc cout_total duree_intervention_par_heure",
        TEXT: """date_declaration date_creation_ot date_debut_reparation date_cloture date_reouverture
            date_validation date_rejet vandalisme palliative avec_demande_pdr est_reouvert portfolio etat
            motif_standby anomalie urgence impact_disponibilite site zone famille groupe localisation actif
            demandeur ot_fils createur_ot utilisateur_prestataire responsable_cloture commentaire_cloture
            responsable_reouverture commentaire_ouverture validateur_travaux responsable_rejet motif_rejet
            prestataire description plateforme_creation plateforme_prestataire plateforme_cloture
            plateforme_rejet plateforme_reouverture plateforme_validation""",
    }
)

PREVENTIVE = _schema(
    {
        LONG: "numero_ot id_actif numero_intervention",
        DOUBLE: """pourcentage cout id_responsable_cloture id_responsable_validation id_responsable_rejet
            commentaire_cloture date_rejet""",
        TIME: "date_debut_planifiee date_fin_planifiee date_debut date_fin date_cloture date_validation",
        TEXT: """portfolio famille groupe site zone localisation etage salle actif code_actif nom_intervention
            frequence entite prestataire etat is_reopened motif_standby responsable_cloture
            responsable_validation date_reouverture responsable_reouverture commentaire_ouverture
            responsable_rejet motif_rejet""",
    }
)

SPARE_PARTS = _schema(
    {
        LONG: "id_demande id_ot quantite_dispo",
        DOUBLE: "quantite_demande cout_total",
        TEXT: """date_demande date_validation_superviseur date_cloture date_rejet site etat demandeur validateur
            magasinier responsable_rejet centre_charges motif_rejet article code_article famille magasin
            description""",
    }
)

RAW_TABLES = {"corrective": CORRECTIVE, "preventive": PREVENTIVE, "spare_parts": SPARE_PARTS}
