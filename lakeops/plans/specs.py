"""Gold models and publish targets as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from lakeops.sources.registry import SourceSpec

# Fixed values in this module: the names of the silver and gold columns, the keys,
# tests and declared types of the gold tables.

INVOICES = "silver_invoices"
STOCK = "silver_stock"
BRANCHES = "silver_branches"
SOURCES = (INVOICES, STOCK, BRANCHES)


def silver_sources(root: str, file_format: str = "parquet") -> list[SourceSpec]:
    """The three declared sources below a storage root, one folder a tenant."""
    return [SourceSpec(name, f"{root}/{{tenant}}/{name}", file_format) for name in SOURCES]


STAMP = "data_atualizacao"


@dataclass(frozen=True)
class ModelSpec:
    """A gold table made from one source by renaming columns.

    ``columns`` maps gold to silver names, ``keys`` are gold names. ``undefined``
    lists gold columns whose NULLs become the "not defined" code. ``keep_version``
    adds the commit version to gold, to publish by.
    """

    name: str
    source: str
    keys: tuple[str, ...]
    columns: dict[str, str]
    require_key: bool = True
    distinct_full: bool = False
    undefined: tuple[str, ...] = ()
    keep_version: bool = False
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()

    @property
    def source_keys(self) -> list[str]:
        return [self.columns[k] for k in self.keys]

    @property
    def source_columns(self) -> list[str]:
        """Silver columns the model reads, each once."""
        return list(dict.fromkeys(self.columns.values()))


@dataclass(frozen=True)
class PublishSpec:
    """A published table: declared columns in order, key and increment column.

    ``null_safe`` is for keys with NULL parts, which then replace their like.
    """

    name: str
    table: str
    keys: tuple[str, ...]
    columns: dict[str, str] = field(hash=False)
    increment: str = STAMP
    null_safe: bool = False
    schema: str = ""


FATO_FATURAMENTO = ModelSpec(
    name="fato_faturamento",
    source=INVOICES,
    keys=("FaturamentoChaveNF",),
    columns={
        "FaturamentoChaveNF": "CHAVE_NFE",
        "FaturamentoFilial": "COD_FILIAL",
        "FaturamentoFabricante": "COD_FABRICANTE",
        "FaturamentoNumeroNF": "NR_NF",
        "FaturamentoSerieNF": "SERIE_NF",
        "FaturamentoCliente": "CPF_CNPJ_CLIFOR",
        "FaturamentoCFOP": "COD_CFOP",
        "FaturamentoData": "DATA_EMISSAO",
        "FaturamentoProduto": "COD_PRODUTO",
        "FaturamentoOperacao": "COD_CFOP",
        "FaturamentoMunicipioIBGE": "COD_IBGE",
        "FaturamentoVendedor": "COD_VENDEDOR",
        "FaturamentoValorItem": "VALOR_LIQUIDO",
        "FaturamentoVolumeItem": "QUANTIDADE_LT_KG",
        "FaturamentoValorBrutoItem": "VALOR_TOTAL",
        "FaturamentoCancelado": "TIPO_NF",
        "FaturamentoUnidadeMedida": "UNIDADE_MEDIDA",
        "FaturamentoValorConversao": "FATOR_CONVERSAO",
        "FaturamentoLote": "LOTE_INTERNO",
        "FaturamentoTratamento": "COD_TRATAMENTO",
        "FaturamentoVolumeItemKG": "PESO_KG_SEMENTE",
    },
    not_null=("FaturamentoChaveNF",),
    unique=("FaturamentoChaveNF",),
)

FATO_ESTOQUE = ModelSpec(
    name="fato_estoque",
    source=STOCK,
    keys=("EstoqueFilial", "EstoqueProduto", "EstoqueFabricante"),
    columns={
        "EstoqueFilial": "COD_FILIAL",
        "EstoqueProduto": "COD_PRODUTO",
        "EstoqueFabricante": "COD_FABRICANTE",
        "EstoqueSaldo": "QTDE_SALDO_EMBALAGEM",
    },
    require_key=False,
    not_null=("EstoqueFilial", "EstoqueProduto"),
)

DIM_CLIENTE = ModelSpec(
    name="dim_cliente",
    source=INVOICES,
    keys=("ClienteCPFCNPJ",),
    columns={"ClienteCPFCNPJ": "CPF_CNPJ_CLIFOR", "ClienteDescricao": "NOME_CLIEFOR"},
    not_null=("ClienteCPFCNPJ",),
    unique=("ClienteCPFCNPJ",),
)

DIM_VENDEDOR = ModelSpec(
    name="dim_vendedor",
    source=INVOICES,
    keys=("VendedorCodigo",),
    columns={
        "VendedorCodigo": "COD_VENDEDOR",
        "VendedorDescricao": "NOME_VENDEDOR",
        "VendedorCPF": "CPF_VENDEDOR",
    },
    not_null=("VendedorCodigo",),
    unique=("VendedorCodigo",),
)

DIM_PRODUTO = ModelSpec(
    name="dim_produto",
    source=INVOICES,
    keys=("ProdutoCodigo",),
    columns={
        "ProdutoCodigo": "COD_PRODUTO",
        "ProdutoDescricao": "DESC_PRODUTO",
        "ProdutoTipo": "DESC_PRODUTO_PAI",
    },
    not_null=("ProdutoCodigo",),
    unique=("ProdutoCodigo",),
)

DIM_LOTE = ModelSpec(
    name="dim_lote",
    source=INVOICES,
    keys=("LoteNumero",),
    columns={"LoteNumero": "LOTE_INTERNO"},
    distinct_full=True,
    not_null=("LoteNumero",),
    unique=("LoteNumero",),
)

DIM_TRATAMENTO_SEMENTE = ModelSpec(
    name="dim_tratamento_semente",
    source=INVOICES,
    keys=("TratamentoSementeCodigo",),
    columns={"TratamentoSementeCodigo": "COD_TRATAMENTO"},
    distinct_full=True,
    not_null=("TratamentoSementeCodigo",),
    unique=("TratamentoSementeCodigo",),
)

DIM_FILIAL = ModelSpec(
    name="dim_filial",
    source=BRANCHES,
    keys=("FilialCodigo",),
    columns={
        "FilialCodigo": "COD_FILIAL",
        "FilialDescricao": "DESC_FILIAL",
        "FilialCNPJ": "CNPJ",
        "FilialEndereco": "END_COMPLETO",
    },
    not_null=("FilialCodigo",),
    unique=("FilialCodigo",),
)

MODELS = {
    spec.name: spec
    for spec in (
        FATO_FATURAMENTO,
        FATO_ESTOQUE,
        DIM_CLIENTE,
        DIM_VENDEDOR,
        DIM_PRODUTO,
        DIM_LOTE,
        DIM_TRATAMENTO_SEMENTE,
        DIM_FILIAL,
    )
}

PUBLISHED = {
    spec.name: spec
    for spec in (
        PublishSpec(
            "dim_cliente",
            "cliente",
            ("ClienteCPFCNPJ",),
            {
                "ClienteCPFCNPJ": "VARCHAR(50)",
                "ClienteDescricao": "VARCHAR(500)",
                STAMP: "TIMESTAMP",
            },
        ),
        PublishSpec(
            "dim_vendedor",
            "vendedor",
            ("VendedorCodigo",),
            {
                "VendedorCodigo": "VARCHAR(50)",
                "VendedorDescricao": "VARCHAR(500)",
                "VendedorCPF": "VARCHAR(20)",
                STAMP: "TIMESTAMP",
            },
        ),
        PublishSpec(
            "dim_produto",
            "produto",
            ("ProdutoCodigo",),
            {
                "ProdutoCodigo": "VARCHAR(50)",
                "ProdutoDescricao": "VARCHAR(500)",
                "ProdutoTipo": "VARCHAR(500)",
                STAMP: "TIMESTAMP",
            },
        ),
        PublishSpec(
            "dim_lote",
            "lote",
            ("LoteNumero",),
            {"LoteNumero": "VARCHAR(100)", STAMP: "TIMESTAMP"},
        ),
        PublishSpec(
            "dim_tratamento_semente",
            "tratamento_semente",
            ("TratamentoSementeCodigo",),
            {"TratamentoSementeCodigo": "VARCHAR(50)", STAMP: "TIMESTAMP"},
        ),
        PublishSpec(
            "dim_filial",
            "filial",
            ("FilialCodigo",),
            {
                "FilialCodigo": "VARCHAR(50)",
                "FilialDescricao": "VARCHAR(500)",
                "FilialCNPJ": "VARCHAR(20)",
                "FilialEndereco": "VARCHAR(1000)",
                STAMP: "TIMESTAMP",
            },
        ),
        PublishSpec(
            "fato_faturamento",
            "faturamento",
            ("FaturamentoChaveNF",),
            {
                "FaturamentoChaveNF": "VARCHAR(100)",
                "FaturamentoFilial": "VARCHAR(50)",
                "FaturamentoFabricante": "VARCHAR(50)",
                "FaturamentoNumeroNF": "VARCHAR(50)",
                "FaturamentoSerieNF": "VARCHAR(10)",
                "FaturamentoCliente": "VARCHAR(50)",
                "FaturamentoCFOP": "VARCHAR(10)",
                "FaturamentoData": "DATE",
                "FaturamentoProduto": "VARCHAR(50)",
                "FaturamentoOperacao": "VARCHAR(10)",
                "FaturamentoMunicipioIBGE": "VARCHAR(20)",
                "FaturamentoVendedor": "VARCHAR(50)",
                "FaturamentoValorItem": "DECIMAL(18,2)",
                "FaturamentoVolumeItem": "DECIMAL(18,4)",
                "FaturamentoValorBrutoItem": "DECIMAL(18,2)",
                "FaturamentoCancelado": "VARCHAR(50)",
                "FaturamentoUnidadeMedida": "VARCHAR(10)",
                "FaturamentoValorConversao": "DECIMAL(18,6)",
                "FaturamentoLote": "VARCHAR(100)",
                "FaturamentoTratamento": "VARCHAR(50)",
                "FaturamentoVolumeItemKG": "DECIMAL(18,4)",
                STAMP: "TIMESTAMP",
            },
        ),
        PublishSpec(
            "fato_estoque",
            "estoque",
            ("EstoqueFilial", "EstoqueProduto", "EstoqueFabricante"),
            {
                "EstoqueFilial": "VARCHAR(50)",
                "EstoqueProduto": "VARCHAR(50)",
                "EstoqueFabricante": "VARCHAR(50)",
                "EstoqueSaldo": "DECIMAL(18,4)",
                STAMP: "TIMESTAMP",
            },
            null_safe=True,
        ),
    )
}

# The order table, published with an archive of replaced rows.
ORDER_COLUMNS = {
    "pedido_id": "INT",
    "cliente_id": "INT",
    "data_pedido": "DATE",
    "valor_total": "DECIMAL(10,2)",
    "status": "VARCHAR(50)",
    "item_id": "INT",
    "produto_id": "INT",
    "quantidade": "INT",
    "preco_unitario": "DECIMAL(10,2)",
    "subtotal": "DECIMAL(10,2)",
    "dt_atualizacao": "TIMESTAMP",
}
ORDER_HISTORY_COLUMNS = {
    **ORDER_COLUMNS,
    "valid_from": "TIMESTAMP",
    "valid_to": "TIMESTAMP",
    "is_current": "BOOLEAN",
    "change_type": "VARCHAR(10)",
}
ORDER_KEYS = ("pedido_id", "item_id")
ORDER_CLUSTER = ("pedido_id",)
ORDER_SORT = ("data_pedido", "dt_atualizacao")
ORDER_HISTORY_SORT = ("pedido_id", "item_id", "valid_from")
FATO_PEDIDO = PublishSpec(
    "fato_pedido", "fato_pedido", ORDER_KEYS, ORDER_COLUMNS, increment="dt_atualizacao"
)
